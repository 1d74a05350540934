"""License detections and their suppression against brute force, and on long texts."""

import random
import re

from pyspark.sql import functions as F

from llm import license_scan
from tests.llm.helpers import ALNUM, fold, frame


def brute(text):
    """All places of all rules, and those that no kept earlier one of at least their priority contains."""
    joined = " " + " ".join(ALNUM.findall(fold(text))) + " "
    found = []
    for label, keyword, priority, score, regex in license_scan.rules():
        if keyword in joined:
            for m in re.finditer(f"(?<= )(?:{regex})(?= )", joined):
                s = joined.count(" ", 0, m.start()) - 1
                found.append((s, -(s + m.group().count(" ") + 1), -priority, label, score))
    kept = []
    for x in sorted(found):
        if not any(y[1] <= x[1] and y[2] <= x[2] for y in kept):
            kept.append(x)
    return kept


def test_detections_against_brute_force(spark):
    rng = random.Random(9)
    names = ["mit", "apache license version 2", "gpl 3", "cc by nc", "bsd", "public domain", "copyright 2020"]
    rest = ["licensed under the", "under the terms of the", "license", "all rights reserved", "subject to", "x", "ö"]
    rows = [(i, " ".join(rng.choices(names + rest, k=rng.randrange(1, 60)))) for i in range(60)]
    got = {r.doc_id: r.detections or [] for r in license_scan.scan(frame(spark, rows)).collect()}
    assert any(len(x) > 5 for x in got.values())
    for doc, text in rows:
        assert [(x.s, x.minus_e, x.minus_p, x.label, x.score) for x in got[doc]] == brute(text)


def test_long_text_of_one_phrase(spark):
    n = 9000  # more detections than a list is grown by at a time
    docs = spark.createDataFrame([(1, "under the mit license x " * n, "w")], "doc_id long, text string, words string")
    found = license_scan.scan(docs).select(
        "n_words", F.size("base").alias("base"), F.size("detections").alias("kept"), F.col("base")[n - 1]["s"].alias("s")
    )
    assert tuple(found.first()) == (5 * n, n, n, 5 * n - 5)


def test_empty_table(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
