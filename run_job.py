"""File for ``spark-submit``: ``spark-submit run_job.py <job> --input … --output …``."""

from stratalake.jobs import main

if __name__ == "__main__":
    main()
