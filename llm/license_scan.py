"""License scans with ordered signature rules and built-in functions only (operator 8).

A document is looked at closely only if it holds one of a few keywords. Its folded words, joined
by single blanks, are then matched against the rules whose own keyword it holds.
Each rule is a regex with a label, a priority and a confidence: hand-written names of
licenses in the phrasings of ``PHRASES``. A detection that lies within a kept one of the same
or higher priority is suppressed; of equal intervals the higher priority stays.
Base phrases are never suppressed. The score is the highest confidence of a kept detection.

All work is on one row at a time without a shuffle, so no source or text can be hot.

Defined cases: null text has no words, no labels and score 0; repeated rows each give a row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import text_column

#: Words of the folded text, written for text that is not folded yet.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: phrase -> label; every place of these counts.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Every rule's text holds one of these.
GATE = (
    r"(?i)licen[cs]|copyright|spdx|public" + _NO_WORD + r"domain|creative" + _NO_WORD
    + r"commons|cc0|cc" + _NO_WORD + "by|copyleft|all" + _NO_WORD + "rights" + _NO_WORD + "reserved"
)

#: label, keyword, name as a regex over folded words. More specific names come first.
NAMES = [
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version| v)? ?1 1"),
    ("apache", "apache", "apache(?: software)?"),
    ("mit", "mit", "mit"),
    ("mit-0", "mit", "mit(?: 0| no attribution)"),
    ("x11", "x11", "x11"),
    ("isc", "isc", "isc"),
    ("bsd-2-clause", "bsd", "(?:bsd 2 clause|simplified bsd|freebsd)"),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|new bsd|modified bsd|revised bsd)"),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|original bsd)"),
    ("0bsd", "bsd", "(?:0bsd|zero clause bsd)"),
    ("bsd", "bsd", "bsd"),
    ("agpl-3", "affero", "(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?"),
    ("agpl-3", "agpl", "(?:gnu )?agpl(?: version| v)? ?3(?: 0)?"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?2 1"),
    ("lgpl-3", "lesser", "(?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?"),
    ("lgpl-2.1", "lgpl", "(?:gnu )?lgpl(?: version| v)? ?2 1"),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl(?: version| v)? ?3(?: 0)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl"),
    ("gpl-2", "general public", "(?:gnu )?general public license(?: version| v)? ?2(?: 0)?"),
    ("gpl-3", "general public", "(?:gnu )?general public license(?: version| v)? ?3(?: 0)?"),
    ("gpl-2", "gpl", "(?:gnu )?gpl(?: version| v)? ?2(?: 0)?"),
    ("gpl-3", "gpl", "(?:gnu )?gpl(?: version| v)? ?3(?: 0)?"),
    ("gpl", "general public", "(?:gnu )?general public"),
    ("fdl", "documentation", "(?:gnu )?free documentation"),
    ("mpl-2", "mozilla", "mozilla public(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("mpl-1.1", "mozilla", "mozilla public(?: license)?(?: version| v)? ?1 1"),
    ("mpl", "mozilla", "mozilla public"),
    ("epl-2", "eclipse", "eclipse public(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("epl-1", "eclipse", "eclipse public(?: license)?(?: version| v)? ?1(?: 0)?"),
    ("cddl", "cddl", "(?:cddl|common development and distribution)"),
    ("eupl", "eupl", "(?:eupl|european union public)"),
    ("artistic-2", "artistic", "artistic(?: license)? 2(?: 0)?"),
    ("artistic", "artistic", "artistic"),
    ("boost-1", "boost", "boost software"),
    ("zlib", "zlib", "zlib"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("cc0-1", "cc0", "cc0(?: 1 0)?"),
    ("cc-by-nc-sa", "cc by nc sa", "cc by nc sa(?: \\d 0)?"),
    ("cc-by-nc-nd", "cc by nc nd", "cc by nc nd(?: \\d 0)?"),
    ("cc-by-nc", "cc by nc", "cc by nc(?: \\d 0)?"),
    ("cc-by-sa", "cc by sa", "cc by sa(?: \\d 0)?"),
    ("cc-by-nd", "cc by nd", "cc by nd(?: \\d 0)?"),
    ("cc-by", "cc by", "cc by(?: \\d 0)?"),
    ("cc-by", "creative commons", "creative commons attribution(?: \\d 0)?"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: \\d 0)?"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: \\d 0)?"),
    ("odbl", "open database", "open database"),
    ("ofl-1.1", "open font", "sil open font"),
    ("postgresql", "postgresql", "postgresql"),
    ("python-2", "python", "python software foundation"),
]

#: priority, confidence, phrasing. A license names itself best in a machine-readable line.
PHRASES = [
    (6, 0.99, "spdx license identifier {name}"),
    (5, 0.95, "(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?"
              "(?:the |an? )?{name}(?: public)?(?: licen[cs]e)?"),
    (4, 0.9, "under (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?{name}(?: public)?(?: licen[cs]e)"),
    (3, 0.8, "(?:subject to|governed by|covered by) (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?"),
    (2, 0.6, "{name} licen[cs]e"),
]

#: Statements that name no license: label, keyword, priority, confidence, regex.
OTHERS = [
    ("public-domain", "public domain", 3, 0.7,
     "(?:dedicated to|released into|placed in|in) the public domain"),
    ("proprietary", "rights reserved", 1, 0.5, "all rights reserved"),
    ("copyright", "copyright", 1, 0.3, "copyright(?: c)? (?:19|20)\\d\\d"),
    ("copyleft", "copyleft", 1, 0.3, "copyleft"),
]


def rules() -> list[tuple[str, str, int, float, str]]:
    """All rules: label, keyword, priority, confidence, regex."""
    named = [
        (label, keyword, priority, score, phrase.format(name=name))
        for label, keyword, name in NAMES
        for priority, score, phrase in PHRASES
    ]
    base = [(label, phrase, 9, 1.0, phrase) for phrase, label in BASE.items()]
    return base + named + OTHERS


def _rule_table() -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.lit(keyword).alias("keyword"),
                F.lit(priority).alias("priority"),
                F.lit(score).alias("score"),
                F.lit(f"(?<= )(?:{regex})(?= )").alias("regex"),
            )
            for label, keyword, priority, score, regex in rules()
        ]
    )


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(text: Column, rule: Column) -> Column:
    """Where a rule matches: (first word, negative end, negative priority, label, score).

    A mark before each match tells its first word by its number among all words, in one pass.
    """
    marked = F.split(F.regexp_replace(text, rule["regex"], F.lit(f"{_MARK}$0")), " ")
    numbered = F.transform(marked, lambda x, i: F.when(F.startswith(x, F.lit(_MARK)), i - 1))
    first = F.filter(numbered, lambda x: x.isNotNull())
    found = F.regexp_extract_all(text, rule["regex"], F.lit(0))
    places = F.transform(
        F.arrays_zip(first.alias("s"), found.alias("hit")),
        lambda x: F.struct(
            x["s"].alias("s"),
            (-(x["s"] + _blanks(x["hit"]) + 1)).alias("minus_e"),
            (-rule["priority"]).alias("minus_p"),
            rule["label"].alias("label"),
            rule["score"].alias("score"),
        ),
    )
    return F.when(F.size(found) > 0, places).otherwise(F.expr(f"cast(array() as array<{_DETECTION}>)"))


#: Stands before a match; no word holds it.
_MARK = "\x01"
_DETECTION = "struct<s:int,minus_e:int,minus_p:int,label:string,score:double>"
#: Detections whose list is grown at a time; appending copies a list.
_PART = 512
_PRIORITIES = 10


def _unsuppressed(sorted_places: Column) -> Column:
    """Detections not contained in an earlier one of the same or higher priority.

    In order of their first word, longest first, one is contained in an earlier one if that ends as
    late. So the largest end for each priority and all higher ones is all that is carried along.
    """
    none = F.expr(f"cast(array() as array<{_DETECTION}>)")

    def step(acc, x):
        hidden = F.element_at(acc["reach"], 1 - x["minus_p"]) >= -x["minus_e"]
        reach = F.transform(
            acc["reach"],
            lambda r, p: F.when(p <= -x["minus_p"], F.greatest(r, -x["minus_e"])).otherwise(r),
        )
        out = F.when(hidden, acc["out"]).otherwise(F.array_append(acc["out"], x))
        return F.struct(reach.alias("reach"), out.alias("out"))

    def part(acc, i):
        return F.aggregate(
            F.slice(sorted_places, i * _PART + 1, F.lit(_PART)),
            F.struct(acc["reach"].alias("reach"), none.alias("out")),
            step,
            lambda inner: F.struct(
                inner["reach"].alias("reach"), F.concat(acc["out"], inner["out"]).alias("out")
            ),
        )

    start = F.struct(
        F.array_repeat(F.lit(-1), _PRIORITIES).alias("reach"), none.alias("out")
    )
    parts = F.sequence(F.lit(0), F.floor((F.size(sorted_places) - 1) / _PART).cast("int"))
    walked = F.aggregate(parts, start, part, lambda acc: acc["out"])
    return F.when(F.size(sorted_places) > 0, walked).otherwise(none)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_words, base, detections`` (arrays of places, null without keyword).

    ``base`` holds every place of a base phrase, ``detections`` what suppression leaves.
    """
    text = text_column(text_col)
    folded = F.translate("text", _UPPER, _LOWER)
    words = F.concat(
        F.lit(" "), F.array_join(F.regexp_extract_all(folded, F.lit(_FOLDED_WORD), F.lit(0)), " "),
        F.lit(" "),
    )
    table = _rule_table()
    looked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(F.col("text").rlike(GATE), words).alias("words"),
    )
    apt = F.filter(table, lambda r: F.contains(F.col("words"), r["keyword"]))
    found = F.array_sort(F.flatten(F.transform(apt, lambda r: _places(F.col("words"), r))))
    placed = looked.select(
        "doc_id", "n_words", F.when(F.col("words").isNotNull(), found).alias("found")
    )
    return placed.select(
        "doc_id",
        "n_words",
        F.filter("found", lambda x: x["minus_p"] == -9).alias("base"),
        F.when(F.col("found").isNotNull(), _unsuppressed(F.col("found"))).alias("detections"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    none = F.expr("cast(array() as array<string>)")
    base = F.coalesce(F.transform("base", lambda x: x["label"]), none)
    own = F.coalesce(F.transform("detections", lambda x: x["label"]), none)
    score = F.array_max(F.transform("detections", lambda x: x["score"]))
    starts = F.transform("base", lambda x: x["s"])
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size(F.col("base")), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    ).withColumn("n_base", F.greatest("n_base", F.lit(0)))
