"""spark-submit entry for one scheduled run (landing -> Bronze -> Silver -> Gold).

    spark-submit run_job.py --landing <folder> --base <shared folder> [--run-ts 2024-05-01T08:00]
"""

from contrail.plans.job import main

if __name__ == "__main__":
    main()
