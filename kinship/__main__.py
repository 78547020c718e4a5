from kinship.cli import main

raise SystemExit(main())
