import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pyspark.sql.classic.dataframe import DataFrame

from llm import bpe, chat_format, decontaminate, license_scan, token_counts, toxicity
from tests.llm.helpers import ALNUM, corpus, fold, frame, plain

STRANGE = [
    "  a  b\n\n c\t\td  \n", "it's we're I'll 'foo ''s !'s 's't don't x'vey '", "a<|endoftext|> b<|endoftext|>",
    "\n \n x", "é 漢字　字 x 12½ ²³ a1b2", "'re", "x'r", "x 's", "<|endoftext|>", "<|endoftext|><|endoftext|>'s",
    " a\x85b", "'l'll''ll", "end'", "<|endoftext", "😀 👍🏽\u200d x", "\x00\x01 \x7f",
]


@pytest.mark.parametrize("common", [1 << 20, 50, 0])
def test_bpe_equals_the_library_and_returns(spark, common):
    rows = corpus(11, n=30) + [(3000 + i, t) for i, t in enumerate(STRANGE)] + [(3000, STRANGE[0])]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((doc, ids, decoded))
    got = bpe.decode(bpe.encode(frame(spark, rows), common=common)).collect()
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.text) for r in got]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("top,width", [(0xFFFF, 2), (0x10000, 4)])
def test_bpe_table_of_common_pieces_is_narrow(top, width):
    keys, ids = [-5, 9, 3], [[7, top], [], [1, 2, 3]]
    raw = [np.array(x, "<u4").tobytes() for x in ids]
    table = bpe._Common(pa.table({"hash": keys, "ids": pa.array(raw, pa.binary())}))
    assert (table.ids.itemsize, table.first.itemsize) == (width, 4)
    for key, want in zip(keys, ids, strict=True):
        at = int(np.searchsorted(table.hash, np.array([key]).view(np.uint64))[0])
        assert table.ids[table.first[at] : table.first[at + 1]].tolist() == want


def test_bpe_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_hits(docs, items, window):
    pieces = []
    for item, text in items:
        w = ALNUM.findall(fold(text))
        size = min(window, len(w))
        pieces += [(str(item), w[p : p + size]) for p in range(len(w) - size + 1) if size and item is not None]
    out = []
    for doc, text in docs:
        w = ALNUM.findall(fold(text))
        hit, found = set(), set()
        for item, piece in pieces:
            for p in range(len(w) - len(piece) + 1):
                if w[p : p + len(piece)] == piece:
                    hit |= set(range(p, p + len(piece)))
                    found.add(item)
        out.append((doc, len(w), len(hit), ",".join(sorted(found))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [200_000, 7])
def test_decontamination_against_brute_force(spark, block):
    rows = corpus(12, n=40)
    rng = random.Random(12)
    items = []
    for i in range(12):
        w = ALNUM.findall(rng.choice(rows)[1] or "") or ["zz"]
        p = rng.randrange(len(w))
        items.append((i, " ".join(w[p : p + rng.randrange(1, 15)])))
    items += [(3, "nothing like this anywhere"), (None, "a"), (50, None), (51, "..."), (52, items[0][1].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    found = decontaminate.annotate(docs, bench, window=6, block_windows=block)
    got = found.select(
        "row.doc_id", "n_words", decontaminate.hit_words(F.col("spans")).alias("n"),
        F.array_join("items", ",").alias("items"),
    )
    want = brute_hits(rows, items, 6)
    assert plain(got) == want
    clean = decontaminate.drop_contaminated(docs, bench, window=6)
    assert clean.columns == docs.columns
    assert plain(clean, "doc_id") == sorted([(r[0],) for r in want if not r[2]], key=repr)


def test_decontamination_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, [(1, "a b"), (2, None)])
    assert decontaminate.drop_contaminated(docs, none).count() == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decontaminate.annotate(empty, spark.createDataFrame([(1, "a b")], none.schema)).count() == 0


def test_chat_round_trip(spark):
    texts = ["", None, "</s>[INST] ok [/INST]", "<|end|>\n<|start|>user<|message|>x", "\\", "\\<|", "<", "|>", "a<\\|b\\\\", "<|" * 3]
    roles = ["user", "assistant", "system", None, "a<", "<|start|>", "x\ny\\"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in (1, 2, None) for t in range(30)]
    rows += [(3, None, "assistant", "x"), (3, 0, "assistant", "y"), (3, 0, "assistant", "y")]
    log = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat_format.read_back(chat_format.render(chat_format.fold_events(chat_format.conversation_events(log))))
    got = {r.conv_id: r for r in back.collect()}
    for conv in (1, 2, None, 3):
        own = sorted(
            ((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        )
        assert [(x.role, x.text) for x in got[conv].turns] == [x[1:] for x in own]
        assert got[conv].loss_text == "".join(t for _, r, t in own if r == "assistant")


def test_chat_events_fold(spark):
    log = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", "He"), (1, 1, 2, "delta", None, "llo"),
        (1, 1, 3, "regenerate", None, ""), (1, 1, 4, "delta", None, "Good "), (1, 1, 5, "delta", None, "day"),
        (1, 0, 6, "edit", None, "hey"), (2, 0, 0, "delta", "user", "late"), (1, 2, 7, "message", "user", "bye"),
    ]
    rng = random.Random(1)
    rng.shuffle(log)
    events = spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string")
    got = plain(chat_format.fold_events(events), "conv_id", "turn", "role", "text")
    assert got == [(1, 0, "user", "hey"), (1, 1, "assistant", "Good day"), (1, 2, "user", "bye"), (2, 0, "user", "late")]


def test_license_places_and_suppression(spark):
    rows = [
        (1, "Released under the MIT License. under THE mit-license"), (2, "Licensed under the Apache License, Version 2.0."),
        (3, "mit cc_by NC 4.0, cc by sa 4.0"), (4, None), (5, "nothing"), (6, "under the mit, license copyright 2020"),
        (7, "SPDX-License-Identifier: GPL-3.0 All rights reserved"), (7, "SPDX-License-Identifier: GPL-3.0 All rights reserved"),
    ]
    found = license_scan.scan(frame(spark, rows))
    got = {r.doc_id: r for r in found.collect()}
    assert [(x.s, -x.minus_e) for x in got[1].base] == [(1, 5), (5, 9)]
    assert [(x.s, -x.minus_e, x.label) for x in got[2].base] == [(3, 7, "apache-2")]
    assert [x.label for x in got[3].base] == ["cc-by-nc"]
    assert got[4].base is None and got[4].n_words == 0 and got[5].detections is None
    assert {x.label for x in got[7].detections} == {"gpl-3", "proprietary"}
    for places in (got[k].detections for k in (1, 2, 3, 6, 7)):
        for x in places:
            inside = [y for y in places if y is not x and y.s <= x.s and -y.minus_e >= -x.minus_e and y.minus_p < x.minus_p]
            assert not inside
    assert len(license_scan.rules()) > 200


def test_license_base_against_brute_force(spark):
    rng = random.Random(4)
    words = ["under", "the", "MIT", "license", "apache", "version", "2", "cc", "by", "nc", "x", "ö"]
    rows = [(i, rng.choice([" ", "-", ", "]).join(rng.choices(words, k=rng.randrange(1, 300)))) for i in range(40)]
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, rows)).collect()}
    for doc, text in rows:
        w = ALNUM.findall(fold(text))
        want = sorted(
            p for phrase in license_scan.BASE for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()
        )
        assert sorted(x.s for x in got[doc].base or []) == want and got[doc].n_words == len(w)


def test_toxicity_held_out(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(2000)]
    bad = ["zzbad%s" % x for x in "abcdefghij"]
    rows, labels = [], []
    for i in range(1500):
        text = rng.choices(words, k=rng.randrange(5, 300))
        toxic = i % 8 == 0
        if toxic:
            text[:2] = rng.choices(bad, k=2)
        rows.append((i, " ".join(text)))
        if i < 1000:
            labels.append((i, i % 16 != 0, int(toxic)))
    labels = spark.createDataFrame([(a, int(b), c) for a, b, c in labels] + [(None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows + [(9000, None), (9001, " ".join(words * 10))])
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.threshold) >= 0).all() and len(model.threshold) == 2
    graded = toxicity.grade_texts(docs, model)
    got = {r["row"].doc_id: r for r in graded.collect()}
    held = range(1000, 1500)
    assert sum(got[i].toxic != (i % 8 == 0) for i in held) <= 3
    assert not got[9000].toxic and not got[9001].toxic
    assert all(0 <= r.severity <= 2 for r in got.values())
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(not r.toxic for r in got.values())
    none = labels.limit(0)
    assert toxicity.drop_toxic(docs, none).count() == docs.count()
    assert toxicity.grade_texts(docs.limit(0), model).count() == 0


def test_toxicity_sends_only_weighted_features_to_the_driver(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join("w%d" % rng.randrange(10**6) for _ in range(200))) for i in range(400)]
    rows = [(i, x + " zzbad" * (i % 4 == 0)) for i, x in rows]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    sent, before = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda x: sent.append(before(x)) or sent[-1])
    model = toxicity.fit(frame(spark, rows), labels)
    assert len(model.feature) == 3 and (model.weight > 0).all()
    assert sum(x.nbytes for x in sent) < 100_000  # all features of the sample take over a megabyte


@pytest.mark.parametrize("rule", ["most", "start"])
def test_tokens_per_section_against_brute_force(spark, rule):
    rows = corpus(13, n=30) + [(3000 + i, t) for i, t in enumerate(STRANGE)]
    encoding, _ = token_counts._encoding(public_tokenizers.path(token_counts.VOCABULARY))
    want = []
    for doc, text in rows:
        raw = (text or "").encode()
        lines = raw.split(b"\n")
        lines = [x + b"\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
        home = [i for i, x in enumerate(lines) for _ in x]
        count, cross, at = [0] * len(lines), [0] * len(lines), 0
        for token in encoding.encode_ordinary(text or ""):
            size = len(encoding.decode_single_token_bytes(token))
            own = home[at : at + size]
            place = own[0] if rule == "start" else max(sorted(set(own)), key=own.count)
            count[place] += 1
            cross[place] += len(set(own)) > 1
            at += size
        chars = 0
        for i, x in enumerate(lines):
            want.append((doc, i, chars, len(x.decode()), count[i], cross[i]))
            chars += len(x.decode())
    got = token_counts.section_tokens(frame(spark, rows), rule=rule)
    assert plain(got) == sorted(want, key=repr)


def test_tokens_empty_table(spark):
    assert token_counts.section_tokens(spark.createDataFrame([], "doc_id long, text string")).count() == 0
