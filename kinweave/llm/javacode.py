"""Functions in Java, where neither Spark's expressions nor arrays can take one step after another.

A source file beside this module is compiled in the driver by the compiler that Spark has for its own generated code, and given to
the executors as a jar of the session; no other compiler or file is needed there."""

from __future__ import annotations

import os
import tempfile
import zipfile
from importlib import resources

from pyspark.sql import SparkSession
from pyspark.sql.types import _parse_datatype_string

#: By application and source, a folder of the driver with the jar; it goes when the driver ends.
_JARS: dict[tuple[str, str], tempfile.TemporaryDirectory] = {}


def register(spark: SparkSession, source: str, values: dict[str, object], functions: dict[str, tuple[str, str]]) -> None:
    """source: a file's name. values: what stands for @name@ in it. functions: by name, a class and what it returns."""
    jvm, key = spark.sparkContext._jvm, (spark.sparkContext.applicationId, source)
    if key not in _JARS:
        code = resources.files(__package__).joinpath(source).read_text(encoding="utf-8")
        for name, value in values.items():
            code = code.replace(f"@{name}@", str(value))
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(code)
        folder = tempfile.TemporaryDirectory(prefix="kinweave-")
        with zipfile.ZipFile(f"{folder.name}/{key[0]}-{source}.jar", "w") as jar:
            for name, data in dict(compiler.getBytecodes()).items():
                jar.writestr(f"{name.replace('.', '/')}.class", bytes(data))
        _JARS[key] = folder
    spark.sql(f"ADD JAR '{os.path.realpath(_JARS[key].name)}/{key[0]}-{source}.jar'")
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()  # has the session's jars
    for name, (kind, returns) in functions.items():
        made = jvm.java.lang.Class.forName(kind, True, loader).getDeclaredConstructors()[0].newInstance(None)
        spark._jsparkSession.udf().register(name, made, spark._jsparkSession.parseDataType(_parse_datatype_string(returns).json()))
