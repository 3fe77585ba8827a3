"""Maps as data: parsing, static checks and compilation to column expressions."""
