import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="noticespark-test-")
    s = (SparkSession.builder.master("local[*]").appName("noticespark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def one_col(spark, values, typ="string"):
    """Small literal input for expression tests: (i, v) rows."""
    from pyspark.sql import types as T
    tmap = {"string": T.StringType(), "double": T.DoubleType()}
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", tmap[typ])])
    return spark.createDataFrame(list(enumerate(values)), schema)
