from ferry.cli import main

main()
