import sys

from .run import main

main(sys.argv[1:])
