"""The filter audit against filters applied one after the other in plain Python."""

import itertools
import random
import re

import numpy as np

from tessera.llm import filter_audit as fa

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def fails(docs):
    """Set of failed filters of each (doc_id, text, lang) row."""
    out = []
    for i, text, _ in docs:
        text = text or ""
        words, bad = SPACES.findall(text), set()
        if len(words) < 100:
            bad.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            bad.add("C")
        if re.search(r"[#$%&*|]", text):
            bad.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs):
            bad.add("E")
        out.append(bad)
    return out


def brute(docs, labels):
    failed, rows = fails(docs), {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for part in {lang or "" for _, _, lang in docs}:
        own = [(d[0], bad) for d, bad in zip(docs, failed) if (d[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                rows[part, order, step] = [
                    len(left), len(gone), sum(f in b for _, b in own) - len(gone), sum(b == {f} for _, b in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def made(df):
    return {(r.part, r.filter_order, r.step): tuple(r[m] for m in fa.MEASURES) for r in df.collect()}


def test_audit_equals_filters_in_every_order(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["aa", "Bb", "CC", "d", "e%", "é", "x#"]) + str(rng.randrange(spread)) for _ in range(n))
             for n in (0, 5, 60, 99, 100, 101, 130) for spread in (3, 60, 900)]
    texts += [None, "", " \n", "A" * 9, "漢" * 50, "a " * 100, "🙂\x85 " * 120, "W" * 200_000]
    docs = [(i if rng.random() > 0.1 else None, rng.choice(texts), rng.choice(["en", "fr", None, ""])) for i in range(150)]
    docs += docs[:20] + [(0, "twice", "en"), (0, "twice", "fr"), (0, "twice", "fr"), (1, "twice", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(100)] + [(None, 1, 1), (3, 1, 1), (3, 0, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").selectExpr(
        "*", "'x' AS part", "1 AS bits", "2 AS digest", "3 AS good", "4 AS quality", "5 AS n")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "9 AS lang", "'q' AS text")
    found = made(fa.audit(df.repartition(5), marks))
    assert len(found) == 600 * 3
    assert found == brute(docs, labels)


def test_no_documents_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(docs.limit(0), labels).count() == 0
    assert made(fa.audit(docs, labels)) == brute([(1, "a", "en")], [])


def test_contraction_of_other_sizes():
    """Two filters: the tensor is small enough to write the measures down."""
    n = np.array([[[5, 2], [3, 1]]])  # axes A, B: passes both 5, fails B 2, fails A 3, fails both 1
    found = fa.measures(n, n * 0, n)
    assert fa.orders(2) == [(0, 1), (1, 0)]
    assert found["removed"].tolist() == [[[4, 2], [3, 3]]]
    assert found["kept"].tolist() == [[[7, 5], [8, 5]]]
    assert found["redundant"].tolist() == [[[0, 1], [0, 1]]]
    assert found["unique_fails"].tolist() == [[[3, 2], [2, 3]]]
    assert found["shapley"].tolist() == [[[7, 5], [5, 7]]]
    assert found["toxic_lost"].tolist() == found["removed"].tolist() and not found["good_lost"].any()
