"""The filter audit against applying every order to every document."""

from __future__ import annotations

import random
import re
from itertools import permutations

from strataload.llm import filteraudit

from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def failures(rows):
    """(part, doc_id, letters it fails) of (doc_id, text, lang)."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t],
        }
        out.append((lang or "", i, {c for c, bad in tests.items() if bad}))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs, out, shapley = failures(rows), {}, {}
    for part in {p for p, _, _ in docs}:
        own = [(i, f) for p, i, f in docs if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, c in enumerate(order, 1):
                gone = [(i, f) for i, f in left if c in f]
                redundant = sum(c in f for _, f in own) - len(gone)
                left = [(i, f) for i, f in left if c not in f]
                shapley[part, c] = shapley.get((part, c), 0) + len(gone)
                out[part, order, step] = (
                    len(left), len(gone), redundant, sum(f == {c} for _, f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), c,
                )
    return {k: (*v[:-1], shapley[k[0], v[-1]]) for k, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], "doc_id long, text string, lang string, n long, digest string, mask int")
    masks = filteraudit.document_masks(docs, spark.createDataFrame([(*r, "x", 1) for r in labels], LABELS), filteraudit.text_failures(F.col("text")))
    got = filteraudit.audit(masks, "ABCDE").collect()
    assert len({(r.part, r.filter_order, r.step) for r in got}) == len(got)
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got
    }


def test_audit_equals_applying_the_filters(spark):
    rng = random.Random(11)
    rows = []
    for i in range(60):
        words = [rng.choice("abcdefgh") * rng.randint(1, 4) if rng.random() < 0.5 else f"w{rng.randint(0, 900)}" for _ in range(rng.choice((3, 190, 260)))]
        text = "\t".join(words[:5]) + "\x0b" + " ".join(words[5:]) + rng.choice(("", " 50%", "AB" * 30))
        rows.append((i, text, rng.choice(("en", "de", "", None))))
    rows += [(100 + i, rows[i % 3][1], rng.choice(("en", "de"))) for i in range(40)]  # copies across parts
    rows += [(0, rows[0][1], "en"), (0, rows[0][1], "en"), (0, rows[1][1], "de"), (None, rows[2][1], "en"), (200, "", "en"), (201, None, "en"), (202, " \n", "fr")]
    rows += [(None, "é ü" * 300, None), (None, None, None), (203, "x " * 200_000 + "Y" * 100_000, "en")]
    labels = [(i, i % 2, (i // 2) % 3 == 0) for i in range(0, 140, 2)]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(4, 1, None), (4, None, 1), (None, 1, 1), (999, 1, 1), (203, 1, 1)]
    assert audited(spark, rows, labels) == brute(rows, labels)


def test_one_text_in_most_rows(spark):
    rows = [(i, "same", "en" if i % 5 else "de") for i in range(2000)] + [(5000, "other", "en")]
    assert audited(spark, rows, [(7, 1, 1)]) == brute(rows, [(7, 1, 1)])


def test_no_documents(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}


def test_intervals_cover_each_rank_once():
    for mask in range(1, 8):
        ranks = [r for m, _, a, b, early in filteraudit.mask_intervals("ABC") if m == mask and not early for r in range(a, b)]
        assert sorted(ranks) == list(range(6))  # every order removes the document at exactly one step
