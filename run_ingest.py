"""Starts the ingest streams under spark-submit; see ``sluice.jobs``."""

from pyspark.sql import SparkSession

from sluice.jobs import main

if __name__ == "__main__":
    try:
        main()
    finally:
        active = SparkSession.getActiveSession()
        if active is not None:
            active.stop()
