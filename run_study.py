"""Entry point for ``spark-submit run_study.py``; options in ``linetone.cli``."""

from linetone.cli import main

if __name__ == "__main__":
    raise SystemExit(main())
