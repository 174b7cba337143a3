from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "admesh") -> SparkSession:
    """A local session for tests and benchmarks. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
