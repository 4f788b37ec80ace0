"""Small tables for the tests of the corpus operators."""

import random

from pyspark.sql import types as T

WORDS = "the of and to in a is that for it was on are as with his they at be this from have or by one had not but".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    made = [r.choice(WORDS) if r.random() < .4 else "".join(r.choice("abdeilmnorst") for _ in range(r.randint(3, 9)))
            for _ in range(n)]
    return " ".join(made)


#: Columns beside those of the table, named like others that the operators make.
CLASH = ("row", "kept", "key", "block", "cid", "sequence_id", "text_crc32", "_text", "bucket")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in CLASH]])


def table(spark, rows):
    return spark.createDataFrame([(i, t, *[f"{c}{i}" for c in CLASH]) for i, t in rows], SCHEMA)
