from kinmatch.plans.cli import main

main()
