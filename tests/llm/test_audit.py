"""The filter audit against a walk through all orders."""

import re
from itertools import permutations

from plantspark.llm import filter_audit


def by_walking(rows, labels):
    """rows: (id, text, part). Every order is applied to the documents left, one filter at a time."""
    texts = [t or "" for _, t, _ in rows]
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    copies = [i is not None and any(j is not None and j < i and u == t for (j, *_), u in zip(rows, texts, strict=True)) for (i, *_), t in zip(rows, texts, strict=True)]
    fails = [
        {f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), c,
        ), strict=True) if bad}
        for t, w, c in zip(texts, words, copies, strict=True)
    ]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, shapley = {}, {}
    for part in {p or "" for _, _, p in rows}:
        own = [k for k, (_, _, p) in enumerate(rows) if (p or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                before = {f for f in order[: step - 1]}
                redundant = sum(f in fails[k] and bool(fails[k] & before) for k in own)
                left = [k for k in left if f not in fails[k]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), redundant, sum(fails[k] == {f} for k in own),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone),
                ]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def compare(spark, docs, rows, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    got = filter_audit.audit(docs, table).collect()
    assert got[0].__fields__[:3] == ["part", "filter_order", "step"]
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == by_walking(rows, [x[:3] for x in labels]) and len(got) == len({tuple(r[:3]) for r in got})


def test_every_order(spark, odd, odd_rows):
    labels = [(i, i % 2, (i % 3) // 2, "x") for i in range(60)] + [(3, 0, 1, None), (3, 1, None, None), (None, 1, 1, ""), (9, None, None, ""), (9, 1, 0, "")]
    compare(spark, odd, [(r[0], r[1], r[2]) for r in odd_rows], labels)


def test_copies_across_parts_and_ids(spark):
    long_ = " ".join(f"w{i}" for i in range(220))
    rows = [(i, long_, ["en", None, "", "fr"][i % 4]) for i in range(5, 60)]
    rows += [(5, long_, "fr"), (5, long_, "en"), (5, long_, "en"), (None, long_, "en"), (None, long_, "en"), (6, long_ + " #", "de"), (6, long_, "de")]
    rows += [(100 + i, "A B C" * i, "de") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    compare(spark, docs, rows, [(5, 1, 1, ""), (6, 1, 0, ""), (150, 0, 1, "")])
    compare(spark, docs, rows, [(None, None, None, None)])


def test_audit_of_nothing(spark, none):
    assert filter_audit.audit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
