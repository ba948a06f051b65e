from runway.jobs import main

main()
