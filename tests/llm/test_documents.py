"""Document operators against brute force on rows with NULLs, repeats, ties, empty and long texts."""

from __future__ import annotations

import random
import re
import string
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import BASE, EDGE
from pyspark.sql import functions as F
from strataload.llm import exactdup, linedup, neardup, packing, secrets, sharding, substring

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def norm(text):
    return (text or "").translate(LOW)


@pytest.mark.parametrize("digest", [exactdup.sha256, lambda norm: norm.substr(1, 0)])
def test_exact_groups(edge, digest):
    """Also with a digest that all texts share: contents decide."""
    groups = defaultdict(list)
    for i, t in EDGE:
        groups[norm(t)].append(i)
    want = Counter()
    for i, t in EDGE:
        ids = groups[norm(t)]
        keep = max((x for x in ids if x is not None), default=None)
        want[(i, keep, len(ids), i == keep)] += 1
    got = exactdup.exact_groups(edge, salts=3, digest=digest).drop("digest").collect()
    assert Counter(map(tuple, got)) == want
    kept = exactdup.exact_dedup(edge, salts=3, digest=digest)
    assert kept.columns == edge.columns
    assert sorted(norm(r.text) for r in kept.collect()) == sorted(groups)


def test_sharding(edge):
    rows = sharding.shard_documents(edge, shards=5).collect()
    assert len(rows) == len(EDGE)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 100, 1009])
def test_permutation_and_inverse(spark, n):
    numbers = spark.range(n)
    rows = numbers.select("id", sharding.permuted(numbers.id, n, 5).alias("p"))
    rows = rows.select("id", "p", sharding.original(rows.p, n, 5).alias("back")).collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_line_dedup(edge, documents):
    got = {r.doc_id: (r.n_lines, r.n_deleted, r.text) for r in linedup.line_dedup(documents(EDGE[11:15]), 2).collect()}
    assert got[12] == (4, 0, "a\nb\nc\nd") and got[13] == (4, 2, "x\ny")
    rows = linedup.line_dedup(edge, 2).collect()
    assert len(rows) == len(EDGE)
    got = {r.doc_id: r for r in rows}
    assert got[14].text == "" and got[14].n_deleted == 2 and got[15].n_deleted == 3 and got[3].n_lines == 1


@pytest.mark.parametrize("least", [1, 3, 4])
def test_line_runs_by_brute_force(documents, least):
    rng = np.random.default_rng(least)
    docs = [(i, "\n".join(rng.choice(list("abcd"), rng.integers(0, 12)))) for i in range(25)]
    seen, gone = set(), set()
    for i, t in docs:
        lines = t.split("\n")
        for p in range(len(lines) - least + 1):
            key = tuple(lines[p : p + least])
            if key in seen:
                gone |= {(i, q) for q in range(p, p + least)}
            seen.add(key)
    got = {r.doc_id: r.text for r in linedup.line_dedup(documents(docs), least).collect()}
    assert got == {i: "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in docs}


def test_single_lines_of_some_words_by_brute_force(documents):
    rng = np.random.default_rng(8)
    lines = ["a b c", "one two\tthree four", "\u00a0 x \u00a0 y z", "", "p q"]
    docs = [(i, "\n".join(rng.choice(lines, rng.integers(0, 7)))) for i in range(25)]
    pairs, single, gone = set(), set(), set()
    for i, t in docs:
        parts = t.split("\n")
        for p, line in enumerate(parts):
            if len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= 4:
                gone |= {(i, p)} if line in single else set()
                single.add(line)
            if p + 1 < len(parts):
                gone |= {(i, p), (i, p + 1)} if (line, parts[p + 1]) in pairs else set()
                pairs.add((line, parts[p + 1]))
    got = {r.doc_id: r.text for r in linedup.line_dedup(documents(docs), 2, 4).collect()}
    assert got == {i: "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) for i, t in docs}


def test_maximal_line_runs(documents):
    """Copies of 1, 2, 3, 5 and 300 lines: each run repeats its first place, none lies in another, together they are the brute-force cover."""
    rng = np.random.default_rng(11)
    fresh = iter(range(10**6))
    own = lambda n: [f"own {next(fresh)}" for _ in range(n)]
    blocks = [own(n) for n in (1, 2, 3, 5, 300)]
    texts = [own(2) + block + own(1) for block in blocks]
    texts += [own(int(rng.integers(0, 3))) + blocks[b] + own(1) + blocks[(b + 1) % 5][:2] for b in range(5)]
    texts += [blocks[4], blocks[4][7:], list("abababab"), [], ["one two three four"], own(1) + ["one two three four"]]
    docs = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    lines = {i: t.split("\n") for i, t in docs}
    runs = linedup.repeated_runs(documents(docs), 2, 4).collect()
    for r in runs:
        n, first = r.end - r.pos + 1, r["first"]
        assert lines[r._id][r.pos : r.end + 1] == lines[first._id][first.pos : first.pos + n]
        assert (first._id, first.pos) < (r._id, r.pos) and (n >= 2 or len(lines[r._id][r.pos].split()) >= 4)
        assert not any(q is not r and q._id == r._id and q.pos <= r.pos and r.end <= q.end for q in runs)
    seen, want = set(), set()
    for i, t in lines.items():
        for p, line in enumerate(t):
            for key in [tuple(t[p : p + 2])] * (p + 1 < len(t)) + [(line,)] * (len(line.split()) >= 4):
                want |= {(i, p + k) for k in range(len(key))} if key in seen else set()
                seen.add(key)
    assert {(r._id, p) for r in runs for p in range(r.pos, r.end + 1)} == want
    sizes = {(r._id, r.end - r.pos + 1) for r in runs}
    # The period of text 12 has its first copies at changing places, so its runs overlap.
    assert {(9, 300), (10, 300), (11, 293), (15, 1)} <= sizes and sum(i == 12 for i, _ in sizes) >= 1


def test_substring_dedup(documents):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 6))
    passage = " ".join(word() for _ in range(60))
    fresh = lambda: " ".join(word() for _ in range(80))
    docs = [(1, fresh() + " " + passage), (2, fresh() + passage + fresh()), (3, fresh()), (4, None), (5, ""), (None, "é" * 500)]
    rows = {r.doc_id: r for r in substring.substring_dedup(documents(docs)).collect()}
    assert rows[1].n_deleted == rows[3].n_deleted == 0 and rows[3].text == docs[2][1]
    assert rows[2].deleted_bytes > 200 and passage[60:-60] not in rows[2].text
    assert rows[4].text == rows[5].text == "" and rows[None].text.strip("é") == ""


@pytest.mark.parametrize("words", [50, 55, 60])
def test_substring_dedup_by_brute_force(documents, words):
    """Passages between unique neighbours, with copies of different length, inside one text, and overlapping ones."""
    rng = np.random.default_rng(words)
    text = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnopé"), rng.integers(1, 9))) for _ in range(n))
    passages = [text(words) for _ in range(12)]
    docs = [(i, text(30) + p + text(30)) for i, p in enumerate(passages)]
    docs += [(100 + i, text(9) + p + text(9)) for i, p in enumerate(passages)]
    # The first copy of a gram is shorter than the second, which alone is long enough at the third's ends.
    docs += [(200 + i, text(9) + p[:cut] + text(9)) for i, (p, cut) in enumerate(zip(passages, range(90, 150, 5)))]
    docs += [(-50 + i, text(5) + p[30:130] + text(5)) for i, p in enumerate(passages)]
    docs += [(300, passages[0] + passages[1] + text(5) + passages[0]), (301, "ab " * 100 + text(3) + "ab " * 90), (None, "x" * 300), (302, "y" * 127 + "x" * 200)]
    seen, want = set(), {}
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        data = t.encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 127):
            window = data[p : p + 128]
            if window in seen:
                gone[p : p + 128] = True
            seen.add(window)
        turns = np.flatnonzero(np.diff(np.r_[0, gone, 0])).tolist()
        spans = []
        for a, b in zip(turns[::2], turns[1::2]):
            while a < b and data[a] & 0xC0 == 0x80:
                a += 1
            while a < b < len(data) and data[b] & 0xC0 == 0x80:
                b -= 1
            spans += [f"{a}:{b}"] if a < b else []
        want[i] = ",".join(spans)
    rows = {r.doc_id: r for r in substring.substring_dedup(documents(docs)).collect()}
    assert {i: r.deleted_spans for i, r in rows.items()} == want
    assert all(rows[100 + i].deleted_bytes >= len(p.encode()) for i, p in enumerate(passages))


def test_windows_decide_their_chunk():
    """Equal windows hold equal chunks at equal places, whatever lies around them, and every window has one."""
    rng = np.random.default_rng(1)
    for least in (2, 3, 16, 31, 128):
        for letters in (1, 2, 200):
            core, known = rng.integers(0, letters, least + 40), {}
            for _ in range(6):
                around = [rng.integers(0, letters, rng.integers(0, 90)) for _ in range(2)]
                text = np.concatenate([around[0], core, around[1]]).astype(np.uint8)
                start, end, first, last = substring.chunks(text, least)
                digests = substring.Digests(text).of(start, end)
                assert first[0] == 0 and last[-1] == len(text) - least and (first[1:] == last[:-1] + 1).all()
                for w in range(len(text) - least + 1):
                    k = np.searchsorted(first, w, "right") - 1
                    assert w <= start[k] and end[k] <= w + least
                    assert known.setdefault(text[w : w + least].tobytes(), (start[k] - w, digests[k])) == (start[k] - w, digests[k])


@pytest.mark.parametrize("least", [2, 5, 17])
def test_short_repeated_spans_by_brute_force(documents, least):
    rng = np.random.default_rng(least)
    docs = [(i, "".join(rng.choice(list("abcé"), rng.integers(0, 40)))) for i in range(12)] + [(50, "a" * 30), (50, "a" * 30)]
    seen, gone = set(), {}
    for i, t in docs[:-1]:
        data = t.encode()
        gone[i] = np.zeros(len(data), bool)
        for p in range(len(data) - least + 1):
            if data[p : p + least] in seen:
                gone[i][p : p + least] = True
            seen.add(data[p : p + least])
    rows = substring.substring_dedup(documents(docs), least).collect()
    assert len(rows) == len(docs)
    for r in rows:
        turns = np.flatnonzero(np.diff(np.r_[0, gone[r.doc_id], 0]))
        data = np.frombuffer(dict(docs)[r.doc_id].encode(), np.uint8)
        want = substring.deleted_spans(data, turns[::2], turns[1::2]) if len(turns) else []
        assert r.deleted_spans == ",".join(f"{a}:{b}" for a, b in want)


def brute_near(docs, percent=75):
    sets = [neardup.shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        groups[find(k)].append(i)
    return sorted((i, len(sets[k]), min(groups[find(k)])) for k, (i, _) in enumerate(docs))


def near(docs, documents, **settings):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_groups(documents(docs), **settings).collect())


def test_near_groups_edge(edge, documents):
    docs = [(i, t) for i, t in dict(x for x in EDGE if x[0] is not None).items()]
    assert near(docs, documents) == brute_near(docs)
    rows = neardup.near_groups(edge).collect()
    assert len(rows) == len(EDGE)
    assert sum(r.n_shingles == 0 for r in rows) == 4  # NULL, empty, and two of white space
    assert neardup.near_dedup(edge).columns == edge.columns


def test_near_groups_of_edited_copies(documents):
    """A large group of near copies that reaches deep levels, beside others."""
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(3000)]
    docs = []
    for base in range(3):
        text = list(rng.choice(words, 120))
        for _ in range(60):
            copy = list(text)
            for at in rng.choice(120, rng.integers(0, 6), replace=False):
                copy[at] = rng.choice(words)
            docs.append((len(docs), " ".join(copy)))
    assert near(docs, documents, node_size=4, pivots=2) == brute_near(docs)


def test_secrets(edge, documents):
    text = "é token = 'abcdef12' Api_Key:x AKIA" + "A1" * 8 + " " + "0f" * 12 + " secret=token: abcdefgh"
    rows = secrets.find_secrets(documents([(1, text), (2, None), (3, "")]), "spans", table=[0.0] * len(secrets.ALPHABET) ** 2)
    got = {r.doc_id: r for r in rows.select("doc_id", secrets.written(rows.spans).alias("s"), secrets.redacted(rows.text, rows.spans).alias("t")).collect()}
    assert [text[int(a):int(b)] for _, a, b in (s.split(":") for s in got[1].s.split(","))] == [
        "token = 'abcdef12", "AKIA" + "A1" * 8, "0f" * 12]
    assert got[1].t == "é [secret]' Api_Key:x [secret] [secret] secret=token: abcdefgh"
    assert got[2].s == got[3].s == "" and got[2].t is None
    assert secrets.find_secrets(edge, "spans").count() == len(EDGE)


def test_base_spans_equal_a_scan_of_every_text(spark):
    """Every whole text of a corpus against the patterns, match by match."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = secrets.find_secrets(docs, "spans", table=[0.0] * len(secrets.ALPHABET) ** 2)
    got = {r.doc_id: r.s for r in rows.select("doc_id", secrets.written(rows.spans).alias("s")).collect()}
    hits = 0
    for r in docs.collect():
        found = []
        for kind, (pattern, group, least) in secrets.BASE.items():
            found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, r.text or "", re.ASCII) if len(m.group(group)) >= least]
        found.sort(key=lambda f: (f[0], list(secrets.BASE).index(f[1])))
        hits += len(found)
        assert got[r.doc_id] == ",".join(f"{k}:{a}:{b}" for a, k, b in found)
    assert hits > 20


def brute_ratio(token, table):
    places = [secrets.ALPHABET.find(c) for c in token]
    return sum(table[a * len(secrets.ALPHABET) + b] for a, b in zip(places, places[1:]) if a >= 0 and b >= 0)


def test_markov_spans_by_brute_force(spark, documents):
    rng = random.Random(9)
    table = [rng.uniform(-2, 3) for _ in range(len(secrets.ALPHABET) ** 2)]
    token = lambda: "".join(rng.choice("abcXYZ019abcXYZ019-/") for _ in range(rng.randint(10, 40)))
    rows = [(i, " é ".join(rng.choice((token(), "token=" + token(), "0f" * 14, "AKIA" + "B" * 20)) for _ in range(12))) for i in range(40)]
    got = secrets.find_secrets(documents(rows), "spans", table=table, least_ratio=2.0)
    got = {r.doc_id: r.s for r in got.select("doc_id", secrets.written(F.filter("spans", lambda s: s["kind"] == len(secrets.BASE))).alias("s")).collect()}
    kept = 0
    for i, text in rows:
        base = [(m.start(), m.end()) for p, g, least in secrets.BASE.values() for m in re.finditer(p, text, re.ASCII) if len(m.group(g)) >= least]
        found = [m.span() for m in re.finditer(secrets.CANDIDATE, text) if brute_ratio(m.group(), table) >= 2.0]
        found = [(a, b) for a, b in found if not any(x < b and a < y for x, y in base)]
        kept += len(found)
        assert got[i] == ",".join(f"markov:{a}:{b}" for a, b in found)
    assert kept > 20


def test_secrets_of_very_long_texts_take_linear_time(documents):
    rng = random.Random(1)
    token = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(1_000_000))
    many = " ".join(f"password=abc{i:06d}" for i in range(30_000))
    began = time.time()
    rows = secrets.find_secrets(documents([(1, f"x {token} y"), (2, many)]), "spans", table=[1.0] * len(secrets.ALPHABET) ** 2)
    assert {r.doc_id: r.n for r in rows.select("doc_id", F.size("spans").alias("n")).collect()} == {1: 1, 2: 30_000}
    assert time.time() - began < 60


def test_random_and_ordinary_held_out_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    table = secrets.train(docs)
    n = secrets.judged(docs, table)
    assert n["called_random"] >= 0.95 * (n["called_random"] + n["left_random"]) > 30
    assert n["called_ordinary"] <= 0.02 * (n["called_ordinary"] + n["left_ordinary"])
    plain = ["1234567890123456", "https-example-com-page-12", "/usr/local/share/python/site-packages", "2024-01-01-backup-archive-0001"]
    assert all(brute_ratio(t, table) < 20 for t in plain) and brute_ratio("aK3jf92LmQx81Zp0VtbW7", table) > 20


def test_packing(spark, edge):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = packing.pack_documents(edge, public_tokenizers.path("byte_bpe_50k.json"), capacity=64).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert {r.doc_id for r in rows} == {i for i, _ in EDGE}
    assert [r.length for r in rows if r.doc_id == 3] == [1]
    # Lengths, starts and ids are the tokenizer's own.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in EDGE:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        starts = [0, *range(len(ids) % 64 or 64, len(ids), 64)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want


def test_another_vocabulary_of_the_same_name_is_refused(spark, tmp_path):
    from strataload.llm.bpe import share_file

    for folder, content in (("a", "one"), ("b", "two"), ("c", "one")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "vocabulary.txt").write_text(content)
    path = lambda folder: str(tmp_path / folder / "vocabulary.txt")
    assert share_file(spark, path("a")) == share_file(spark, path("c")) == "vocabulary.txt"
    with pytest.raises(ValueError, match="vocabulary.txt"):
        share_file(spark, path("b"))


def test_packing_exchanges_between_certified_partitions(spark):
    """Every partition ends with a half-empty bin of its own; exchanged, they need no more bins than all pieces' bound."""
    pieces = spark.range(400).selectExpr("id row", "0 piece", "100L length")
    rows = packing.pack_pieces(pieces, capacity=1000, per_partition=50).collect()
    assert len(rows) == 400 and len({r.sequence_id for r in rows}) <= 42


def test_bins_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(1)
    for _ in range(50):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, offsets, count = packing.best_fit_decreasing(lengths, 100)
        bound = packing.bins_bound(np.bincount(lengths, minlength=101), 100)
        assert bound <= count and np.bincount(bins, lengths).max() <= 100
        assert bound >= -(-lengths.sum() // 100)


def test_empty_tables(documents):
    import public_tokenizers

    none = documents([])
    assert exactdup.exact_groups(none).isEmpty() and exactdup.exact_dedup(none).isEmpty()
    assert linedup.line_dedup(none).isEmpty() and substring.substring_dedup(none).isEmpty()
    assert neardup.near_groups(none).isEmpty() and sharding.shard_documents(none).isEmpty()
    assert secrets.find_secrets(none, "s").isEmpty()
    assert packing.pack_documents(none, public_tokenizers.path("byte_bpe_50k.json")).isEmpty()


def test_hashed_sets_equal_real_sets():
    hasher = neardup.Hasher()
    for _, text in [*EDGE, (0, BASE * 9), (0, "a a a a a a a a"), (0, "\x1ca\x85b c d e f")]:
        assert len(hasher.shingles(text, 5)) == len(neardup.shingles(text))




def test_dedup_deals_no_whole_table_for_a_few_shared_texts(spark):
    """With automatic broadcasts off, only rows that share a text are shuffled with their texts, and rows to drop are broadcast."""
    from strataload.llm import exactdup, neardup

    docs = spark.createDataFrame([(k, f"text number {k % 40} of a few words") for k in range(50)], "doc_id long, text string").coalesce(1)
    name = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        for dedup, left in ((exactdup.exact_dedup, range(10, 50)), (neardup.near_dedup, range(40))):
            rows = dedup(docs)
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
            assert sorted(r.doc_id for r in rows.collect()) == list(left)
    finally:
        spark.conf.set(name, kept)


def test_sketches_pass_pairs_over_the_bound_and_few_far_below(spark):
    """With 64 values the bound, 34, lay below the 35 that a similarity of 0.55 gives on average."""
    draw = np.random.default_rng(7)
    hashes = lambda n: draw.integers(0, 2**64, n, dtype=np.uint64)
    rows = []
    for over in (True, False):
        for _ in range(100):
            both = hashes(300)
            own = 45 if over else 123  # 300 / 390 and 300 / 546
            a, b = (np.concatenate([both, hashes(own)]) for _ in "ab")
            rows.append((over, *[neardup.sketch(neardup.minwise(x), x).tolist() for x in (a, b)]))
    found = spark.createDataFrame(rows, "over boolean, a array<long>, b array<long>")
    found = found.withColumn("same", neardup.agreeing(found["a"], found["b"]))
    least = int(256 * 0.8125 - 4 * (256 * 0.8125 * 0.1875) ** 0.5)
    passed = {r["over"]: r["count"] for r in found.filter(found["same"] >= least).groupBy("over").count().collect()}
    assert passed[True] == 100 and passed.get(False, 0) <= 20
    whole = found.withColumn("self", neardup.agreeing(found["a"], found["a"]))
    assert whole.filter("self <> 256").isEmpty()


def test_partners_of_a_node_are_few_and_make_rows_for_likely_pairs_only(spark):
    """A node of 200 unlike classes made 8 rows for each of its classes before sketches were compared."""
    draw = np.random.default_rng(8)
    unlike = [draw.integers(0, 2**64, 80, dtype=np.uint64) for _ in range(200)]
    alike = np.concatenate([unlike[0][:78], draw.integers(0, 2**64, 2, dtype=np.uint64)])
    rows = [(1, bytes([k]), bytes([k]), 80, neardup.sketch(neardup.minwise(x), x).tolist()) for k, x in enumerate([*unlike, alike])]
    nodes = spark.createDataFrame(rows, "node long, id binary, label binary, size long, sketch array<long>").selectExpr("*", "X'FF' main", "false small")
    join = object.__new__(neardup.Join)
    join.pivots, join.percent, join.least = 8, 75, 183
    large = nodes.join(join.partners(nodes, ~nodes["small"]), "node")
    assert large.count() == 201 and large.selectExpr("size(partners) n").distinct().collect()[0]["n"] <= 8
    few = nodes.drop("small").selectExpr("*", "true small")
    pairs = {(bytes(r["a"]), bytes(r["b"])) for r in join.near(few.join(join.partners(few, ~few["small"]), "node")).collect()}
    assert pairs == {(bytes([0]), bytes([200]))}


def test_plain_pieces_encode_as_the_tokenizer_does():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    memo = packing.TokenizerMemo(path)
    parts = [" word", " word.", " word,", "\nWord", "\nword.", " .", "\n.", " a..", " it's", " don't.", " é", " naïve,", " a1", " <|endoftext|>", " x"]
    for part, ids in zip(parts, memo.encode_many(parts)):
        assert np.frombuffer(ids, "<u4").tolist() == memo._ids(memo.tokenizer, part), part
    told = [packing.plain_matches(p) for p in parts]
    assert told[:5] == ["Ġword", "Ġword .", "Ġword ,", "Ċ Word", "Ċ word ."] and not any(told[5:-1])


def test_small_batches_bound_what_a_task_holds_and_are_taken_back(spark):
    from strataload.sources.scratch import settle, small_batches

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    sizes = lambda batches: (b.assign(n=len(b))[["n"]] for b in batches)
    with small_batches(spark, 100):
        seen = settle(spark.range(0, 950, 1, 1).mapInPandas(sizes, "n long"), "sizes")
    assert spark.conf.get(name) == before
    assert seen.count() == 950 and seen.agg({"n": "max"}).first()[0] == 100
