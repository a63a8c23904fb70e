from activlake.cli import main

main()
