"""Java functions for loops that numpy takes many passes for.

The source beside this module is compiled by Janino, which Spark has at hand for its own generated code, once per
application, and sent to the executors as a jar. Rows stay in the JVM: no batch goes to a Python worker and back.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType

SOURCE = Path(__file__).with_name("Forest.java")
#: Functions of the source and the columns that each takes and returns.
FUNCTIONS = {
    "Count": (["rows", "keys"], "tree int, node bigint, counts binary"),
    "Deal": (["rows", "keys"], "tree int, node bigint, rows binary"),
    "Grow": (["tree", "node", "rows"], "tree int, node bigint, subtree binary, importance array<double>"),
    "Ends": (["rows"], "tree int, node bigint, n bigint"),
    "Ask": (["part", "rows"], "tree int, node bigint, block int, kind int, bytes binary"),
    "Answer": (["tree", "node", "block", "kind", "bytes"], "part bigint, kind int, bytes binary"),
    "Total": (["part", "kind", "bytes"], "key bigint, units bigint"),
}
_added: set[str] = set()


def _jar(spark: SparkSession) -> str:
    compiler = spark.sparkContext._jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(spark._jsparkSession.sharedState().jarClassLoader())
    compiler.cook(SOURCE.read_text())
    codes = compiler.getBytecodes()
    path = f"{tempfile.mkdtemp(prefix='orderlens-')}/forest.jar"
    with zipfile.ZipFile(path, "w") as jar:
        for name in codes.keySet():
            jar.writestr(name.replace(".", "/") + ".class", bytes(codes.get(name)))
    return path


def _made(spark: SparkSession, name: str):
    """An instance of a class of the source."""
    context = spark.sparkContext
    if context.applicationId not in _added:
        spark.sql(f"ADD JAR '{_jar(spark)}'").collect()
        _added.add(context.applicationId)
    jvm, gateway = context._jvm, context._gateway
    found = jvm.java.lang.Class.forName(f"orderlens.Forest${name}", True, spark._jsparkSession.sharedState().jarClassLoader())
    return found.getDeclaredConstructor(gateway.new_array(jvm.java.lang.Class, 0)).newInstance(gateway.new_array(jvm.java.lang.Object, 0))


def over(rows: DataFrame, name: str, spec: bytes, walks: bytes = b"", flag: bool = False) -> DataFrame:
    """What a function of the source makes of the rows of each partition."""
    spark = rows.sparkSession
    takes, gives = FUNCTIONS[name]
    encoder = spark.sparkContext._jvm.org.apache.spark.sql.Encoders.row(spark._jsparkSession.parseDataType(DataType.fromDDL(gives).json()))
    function = getattr(_made(spark, name), "with")(spec, walks, flag)
    return DataFrame(rows.select(*takes)._jdf.mapPartitions(function, encoder), spark)
