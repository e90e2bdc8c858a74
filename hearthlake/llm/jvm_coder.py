"""The range coder in the executors' JVM: ``RangeCoder.java``, compiled by Spark's own compiler and sent to them as a jar.

It makes the bytes of ``range_coder``, which states the format and is held against it in
the tests, one id after the other instead of many blocks side by side.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SOURCE = Path(__file__).with_name("RangeCoder.java")
NAMES = {"hearthlake_encode": "array<binary>", "hearthlake_documents": "array<bigint>"}
#: The coder of each running application.
_made: dict[str, object] = {}


def _coder(spark: SparkSession):
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    if context.applicationId not in _made:
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(SOURCE.read_text())
        jar = Path(tempfile.mkdtemp(prefix="hearthlake-")) / f"range-coder-{uuid.uuid4().hex}.jar"
        with zipfile.ZipFile(jar, "w") as file:
            for name, code in dict(compiler.getBytecodes()).items():
                file.writestr(name.replace(".", "/") + ".class", bytes(code))
        context._jsc.addJar(str(jar))
        _made.clear()
        _made[context.applicationId] = compiler.getClassLoader().loadClass("hearthlake.RangeCoder").getDeclaredConstructors()[0].newInstance(context._gateway.new_array(jvm.Object, 0))
    return _made[context.applicationId]


def _call(spark: SparkSession, name: str, *columns: Column) -> Column:
    kind = spark.sparkContext._jvm.org.apache.spark.sql.types.DataType.fromDDL(NAMES[name])
    spark._jsparkSession.udf().register(name, _coder(spark), kind)
    return F.call_function(name, *columns)


def encoded(spark: SparkSession, ids: Column, block: Column) -> Column:
    """The blocks (array<binary>) of ids as little-endian 32-bit integers (binary), ``block`` (int) in each but the last."""
    return _call(spark, "hearthlake_encode", ids, block)


def documents(spark: SparkSession, blocks: Column, lengths: Column) -> Column:
    """Of blocks coded together, that hold documents of these lengths (array<bigint>): offset << 32 | CRC-32 of each one's ids.

    A block whose checksum doesn't hold ends the job with an error.
    """
    return _call(spark, "hearthlake_documents", blocks, lengths)
