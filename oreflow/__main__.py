from oreflow.plans.runner import main

raise SystemExit(main())
