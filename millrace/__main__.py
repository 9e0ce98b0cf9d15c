from millrace.operators.build import main

main()
