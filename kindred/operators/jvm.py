"""The pair kernel that runs inside the executors' JVMs.

``jvm/BestPairs.java`` is compiled on the driver by Janino, the compiler Spark generates code
with, and sent to the executors as a jar, once per application.
"""

from __future__ import annotations

import os
import pkgutil
import tempfile
import zipfile
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructType

from .rows import NAME, POSITION

_CLASS = "kindred.BestPairs"
# Compiled functions by application, registered names by session.
_compiled: dict[str, object] = {}
_registered: WeakKeyDictionary = WeakKeyDictionary()


def available(spark: SparkSession) -> bool:
    """Whether the session has a JVM to compile in; a remote one has not."""
    return getattr(spark, "_jsparkSession", None) is not None


def _function(spark: SparkSession):
    """An instance of the kernel whose classes the executors can load."""
    context = spark.sparkContext
    if (known := _compiled.get(context.applicationId)) is None:
        compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(pkgutil.get_data("kindred", "jvm/BestPairs.java").decode())
        jar = os.path.join(tempfile.mkdtemp(prefix="kindred-jvm-"), "kindred-kernel.jar")
        with zipfile.ZipFile(jar, "w") as out:
            for name, code in compiler.getBytecodes().items():
                out.writestr(name.replace(".", "/") + ".class", bytes(code))
        context._jsc.addJar(jar)
        known = compiler.getClassLoader().loadClass(_CLASS).newInstance()
        _compiled.clear()
        _compiled[context.applicationId] = known
    return known


def _name(spark: SparkSession, position: DataType) -> str:
    """The kernel's SQL name for positions of this type."""
    name = f"kindred_best_pairs_{position.typeName()}"
    names = _registered.setdefault(spark, set())
    if name not in names:
        found = StructType().add("_left_name", StringType()).add("_right_name", StringType())
        found = ArrayType(found.add("_score", DoubleType()).add(POSITION, position))
        session = spark._jsparkSession
        session.udf().register(name, _function(spark), session.parseDataType(found.json()))
        names.add(name)
    return name


def best_pairs(lefts: DataFrame, rights: DataFrame, tile, sure: Column, cfg) -> DataFrame:
    """Each left name's best right names within every tile: ``tile``, _left_name, _right_name, _score, position.

    Left names have 1 to 64 characters.  ``sure`` tells whether a tile's left names have
    ``top_n`` right names, here or elsewhere, whose weighted scores a shared token settles.
    """
    position = rights.schema[POSITION].dataType
    spark = lefts.sparkSession
    # The order that breaks ties; names without a position come last.
    other = F.struct(F.col(POSITION).isNull(), F.col(POSITION).alias("p"), F.col(NAME).alias("n"))
    lefts = lefts.groupBy(*tile).agg(F.collect_list(NAME).alias("_lefts"))
    rights = rights.groupBy(*tile).agg(F.sort_array(F.collect_list(other)).alias("_rights"))
    found = F.call_function(
        _name(spark, position), F.col("_lefts"), sure, F.col("_rights.n"), F.col("_rights.p"),
        F.lit(cfg.scorer), F.lit(float(cfg.score_threshold)), F.lit(int(cfg.top_n)),
    )
    # Both sides are dealt out by tile already.
    return lefts.join(rights.hint("merge"), list(tile)).select(*tile, F.inline(found))
