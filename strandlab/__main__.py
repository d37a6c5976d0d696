from strandlab.plans.run import main

raise SystemExit(main())
