import sys

from chargeline.cli import main

main(sys.argv[1:])
