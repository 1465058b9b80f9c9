"""What the package offers for IDoc documents, as rows: names, parameters and the first lines of their documentation."""

from __future__ import annotations

import inspect

from pyspark.sql import DataFrame, SparkSession

from edispark.functions import encode
from edispark.operators import convert, dictionary, hierarchy, read
from edispark.plans import compose
from edispark.sources import idoc
from edispark.streaming import landing


def entries() -> list[tuple[str, str, str, str]]:
    """(module, name, parameters, description) of every public function."""
    out = []
    for module in (read, convert, dictionary, hierarchy, encode, compose, idoc, landing):
        for name, f in vars(module).items():
            if inspect.isfunction(f) and f.__module__ == module.__name__ and not name.startswith("_") and f.__doc__:
                out.append((module.__name__.split(".", 1)[1], name, str(inspect.signature(f)), " ".join(f.__doc__.split("\n\n")[0].split())))
    return sorted(out)


def describe(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(entries(), "module string, name string, parameters string, description string")
