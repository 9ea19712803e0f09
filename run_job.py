"""Launcher for cluster runs:

    zip -r feedlens.zip feedlens
    spark-submit --py-files feedlens.zip run_job.py etl --feed P --messages P --out P --as-of D
"""
from feedlens.plans.jobs import main

if __name__ == "__main__":
    main()
