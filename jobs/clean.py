"""Start the clean job with spark-submit; see pharmavane/plans/clean.py."""

from pharmavane.plans.clean import main

if __name__ == "__main__":
    main()
