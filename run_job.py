"""Launcher for spark-submit: ``spark-submit --py-files vendorpulse.zip run_job.py <job args>``."""

from vendorpulse.plans.job import main

if __name__ == "__main__":
    main()
