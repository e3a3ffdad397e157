"""Start the ingest job with spark-submit; see pharmavane/plans/ingest.py."""

from pharmavane.plans.ingest import main

if __name__ == "__main__":
    main()
