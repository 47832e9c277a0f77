"""Session for tests."""

from pyspark.sql import SparkSession

from docspark.session import configure


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("docspark-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
