"""Entry point for spark-submit; see gaugelake/plans/jobs.py."""

from gaugelake.plans.jobs import main

if __name__ == "__main__":
    main()
