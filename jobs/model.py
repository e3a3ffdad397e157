"""Start the model job with spark-submit; see pharmavane/plans/model.py."""

from pharmavane.plans.model import main

if __name__ == "__main__":
    main()
