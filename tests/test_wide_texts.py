"""Line breaks and numbers of texts with wide gaps."""

import random
import re
import time

from pyspark.sql import functions as F

from voxtally.functions.prompts import one_line
from voxtally.functions.replies import parse_numbered


def test_wide_gaps_are_tried_once(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice(" \t\n\r\x0b\xa0ab") for _ in range(draw.randrange(30))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.o for r in df.select("t", one_line(F.col("t")).alias("o")).collect()}
    assert got == {t: re.sub(r"\s*[\r\n]+\s*", " ", t, flags=re.ASCII) for t in texts}
    # A run of blanks was tried from each of its characters: 300,000 of them took minutes.
    wide = spark.createDataFrame([("a" + " " * 300_000 + "b \n c",)], "t string")
    began = time.monotonic()
    assert wide.select(F.length(one_line(F.col("t")))).head()[0] == 300_004
    assert wide.select(parse_numbered(F.concat(F.lit("1. "), "t"), 1)[0]).head()[0].endswith("b c")
    assert time.monotonic() - began < 20
