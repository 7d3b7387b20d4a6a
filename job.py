"""``spark-submit --py-files tallyspark.zip job.py RAW_DIR OUTPUT_DIR [--as-of DAY]``"""

from tallyspark.plans.pipeline import main

if __name__ == "__main__":
    main()
