from panelspark.session import build_session


def local_session():
    spark = build_session(
        "panelspark-tests",
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
