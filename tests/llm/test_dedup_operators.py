"""Exact, SimHash and paragraph dedup against brute force, and the components under them."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm_data import HAVE_TABLES, SMALL, edge_docs, no_docs, union_find
from pyspark.sql import functions as F

from ruleforge.llm import exact_dedup, paragraphs, simhash
from ruleforge.llm.components import connected_components

needs_tables = pytest.mark.skipif(not HAVE_TABLES, reason="test tables not present")


def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# ------------------------------------------------------------- components
@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(40)]
    links += [(200, 200 + i) for i in range(1, 30)] + [(5, 5), (None, 3)]
    found = {r.node: r.component for r in connected_components(
        spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    whole = [(a, b) for a, b in links if a is not None and a != b]
    roots = union_find(300, whole)
    assert found == {x: roots[x] for x in {x for p in whole for x in p}}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ------------------------------------------------------------- exact dedup
def brute_exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    return sorted(((i, min((x for x in groups[norm(t)] if x is not None), default=None), len(groups[norm(t)]),
                    hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows), key=str)


@pytest.mark.parametrize("prefix", [1, 256])
def test_exact_groups_match_brute_force(spark, prefix):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = exact_dedup.exact_groups(docs, prefix=prefix, digest_all=True).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest.hex()) for r in found), key=str) == brute_exact(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)
    assert {r.doc_id: r.same_id for r in found}[4] == 2


def test_exact_full_hash_only_for_survivors(spark):
    found = {r.doc_id: r for r in exact_dedup.exact_groups(edge_docs(spark)).collect()}
    assert found[3].digest is None and found[22].digest is not None and found[23].keep_id == 22


def test_exact_keep_one_keeps_rows_whole(spark):
    docs = edge_docs(spark)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ids == sorted({i for i, k, *_ in brute_exact(rows) if i == k}, key=str)
    assert exact_dedup.keep_one(no_docs(spark)).count() == exact_dedup.exact_groups(no_docs(spark)).count() == 0


# ------------------------------------------------------------------ simhash
def brute_fingerprint(text, words=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    span = min(words, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + span]).encode(), 42) for i in range(len(w) - span + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, radius):
    fps = [brute_fingerprint(t) for _, t in rows]
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2)
             if (fps[a] ^ fps[b]).bit_count() <= radius]
    roots = union_find(len(rows), links)
    low = defaultdict(list)
    for (i, _), r in zip(rows, roots):
        low[r].append(i)
    return sorted(((i, f"{f:016x}", min((x for x in low[r] if x is not None), default=None))
                   for (i, _), f, r in zip(rows, fps, roots)), key=str)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_difference(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    # two bits with equal phi fall in the same masks, so the distinct phi decide
    kinds = sorted({tuple(m >> i & 1 for m in masks) for i in range(64)})
    table = np.array(kinds, bool)
    for r in range(1, radius + 1):
        for some in itertools.combinations_with_replacement(range(len(kinds)), r):
            assert not table[list(some)].any(axis=0).all()


def test_simhash_on_awkward_documents(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = simhash.near_groups(docs).select("doc_id", simhash.fingerprint_text(F.col("fp")), "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(rows, 4)
    assert simhash.near_groups(no_docs(spark)).count() == 0


@needs_tables
@pytest.mark.parametrize("radius, block", [(4, 8192), (12, 3)])
def test_simhash_groups_match_all_pairs(spark, radius, block):
    """With a wide radius buckets grow past the small block, so divided buckets are searched too."""
    docs = small(spark).limit(150) if radius == 12 else small(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fixed = spark.createDataFrame(rows, "doc_id bigint, text string")
    if radius == 12:
        fps = [(i, brute_fingerprint(t)) for i, t in rows]
        table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in {f for _, f in fps}], "fp bigint")
        few = simhash.fingerprint_links(table, radius=5, block=block)
        got = {frozenset((r.a % 2**64, r.b % 2**64)) for r in few.collect()}
        want = [frozenset(p) for p in itertools.combinations({f for _, f in fps}, 2) if (min(p) ^ max(p)).bit_count() <= 5]
        assert got <= set(want)
        names = {f: k for k, f in enumerate(sorted({f for _, f in fps}))}
        assert union_find(len(names), [[names[x] for x in p] for p in got]) == union_find(
            len(names), [[names[x] for x in p] for p in want])
        return
    got = simhash.near_groups(fixed, radius=radius, block=block)
    got = got.select("doc_id", simhash.fingerprint_text(F.col("fp")), "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_groups(rows, radius)


def test_dense_bucket_in_blocks(spark):
    """One cluster of 300 fingerprints in few buckets, in blocks of 16: one component, few links."""
    rng = random.Random(1)
    fps = {0x0123456789ABCDEF}
    while len(fps) < 300:
        f = rng.choice(sorted(fps))
        for _ in range(rng.randint(1, 3)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    links = simhash.fingerprint_links(table, block=16).distinct().collect()
    names = {f: k for k, f in enumerate(sorted(fps))}
    pairs = [(names[r.a % 2**64], names[r.b % 2**64]) for r in links]
    assert set(union_find(300, pairs)) == {0} and all(
        (r.a ^ r.b) % 2**64 == (r.a ^ r.b) % 2**64 and ((r.a ^ r.b) % 2**64).bit_count() <= 4 for r in links)


def test_simhash_keep_first(spark):
    docs = edge_docs(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in brute_groups([(r.doc_id, r.text) for r in docs.collect()], 4) if i == c}
    assert {r.doc_id for r in kept.collect()} == want


# --------------------------------------------------------------- paragraphs
def brute_paragraphs(rows, min_words, span=5, threshold=0.8):
    paras = []
    for i, t in rows:
        for no, line in enumerate((t or "").split("\n")):
            w = line.lower().split()
            if len(w) >= min_words and w:
                s = min(span, len(w))
                paras.append((i, no, {tuple(w[k:k + s]) for k in range(len(w) - s + 1)}))
    links = [(a, b) for a, b in itertools.combinations(range(len(paras)), 2)
             if (both := len(paras[a][2] & paras[b][2])) >= threshold * (len(paras[a][2]) + len(paras[b][2]) - both)]
    roots = union_find(len(paras), links)
    sizes = Counter(roots)
    keep = {r: min((p[:2] for p, q in zip(paras, roots) if q == r)) for r in sizes if sizes[r] > 1}
    return sorted((p[0], p[1], keep[r][0], sizes[r], p[:2] != keep[r]) for p, r in zip(paras, roots) if r in keep)


def found_paragraphs(docs, **options):
    got = paragraphs.repeated_paragraphs(docs, passage_words=10**6, **options).collect()
    return sorted((r.doc_id, r.para_no, r.keep_doc_id, r.copies, r.removed) for r in got)


@needs_tables
@pytest.mark.parametrize("min_words, block", [(40, 512), (3, 8)])
def test_paragraph_clusters_match_all_pairs(spark, min_words, block):
    rows = [(r.doc_id, r.text) for r in small(spark).select("doc_id", "text").orderBy("doc_id").collect()]
    rows = rows if min_words > 10 else rows[:60]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_paragraphs(docs, min_words=min_words, block=block) == brute_paragraphs(rows, min_words)


def test_edited_passages_are_one_cluster(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(9999)}" for _ in range(90)]
    rows = [(0, "intro\n" + " ".join(base))]
    for i in range(1, 40):  # one edit each
        copy = list(base)
        copy[rng.randrange(90)] = f"edit{i}"
        rows.append((i, f"own line {i}\n" + " ".join(copy)))
    rows.append((99, " ".join(f"clean{rng.randrange(9999)}" for _ in range(90))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = found_paragraphs(docs, block=8)
    assert [r[0] for r in got] == list(range(40)) and all(r[2:4] == (0, 40) for r in got)
    left = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert left[0] == rows[0][1] and left[7] == "own line 7\n" and left[99] == rows[-1][1]


def test_passages_inside_other_paragraphs(spark):
    """Runs of whole sentences, put in the middle of other sentences, are found in every document."""
    rng = random.Random(8)

    def sentence():
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(3, 12))]
        return " ".join([words[0].capitalize(), *words[1:]]) + "."
    passages = []
    for size in (51, 60, 90, 200):
        text = sentence()
        while len(text.split()) < size:
            text += ("\n" if rng.random() < 0.1 else " ") + sentence()
        passages.append(text)
    rows, want = [], set()
    for i in range(60):
        head, tail = (" ".join(sentence() for _ in range(9)) for _ in range(2))
        if i % 3 == 2:
            rows.append((i, head + " " + tail))
            continue
        p = passages[i % 4]
        head = head[:-1].rsplit(" ", 1)[0] + f" mid{i} "
        rows.append((i, head + p + f" lower{i} " + tail))
        want.add((i, len(head), len(head) + len(p)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = paragraphs.repeated_paragraphs(docs, block=8).where("kind = 'passage'").collect()
    ends = {i: (a, b) for i, a, b in want}
    spans = {r.doc_id: (r.start, r.end) for r in got}
    assert len(got) == len(spans) and set(spans) == set(ends)
    # the start is exact; a last sentence may be left over when no window of enough words ends with it
    assert all(spans[i][0] == a and a + 0.8 * (b - a) <= spans[i][1] <= b for i, (a, b) in ends.items())
    keepers = {p: min(i for i in range(60) if i % 4 == p and i % 3 != 2) for p in range(4)}
    assert all(r.keep_doc_id == keepers[r.doc_id % 4] and r.removed == (r.doc_id != r.keep_doc_id) for r in got)
    left = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    for i, t in rows:
        dropped = i in spans and i != keepers[i % 4]
        assert left[i] == (t[:spans[i][0]] + t[spans[i][1]:] if dropped else t)


@needs_tables
def test_window_keys_match_brute_force(spark):
    docs = small(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_words, by_name = defaultdict(set), defaultdict(set)
    for r in paragraphs.passage_windows(docs).collect():
        words = tuple(texts[r.doc_id][r.start:r.end].lower().split())
        assert len(words) == r.n_words >= 50
        by_words[words].add((r.key, r.content))
        by_name[(r.key, r.content)].add(words)
    assert all(len(v) == 1 for v in by_words.values()) and all(len(v) == 1 for v in by_name.values())


def test_paragraphs_on_awkward_documents(spark):
    docs = edge_docs(spark).where("doc_id is not null")
    found = paragraphs.repeated_paragraphs(docs).collect()
    got = {(r.doc_id, r.para_no): r for r in found if r.kind == "paragraph"}
    assert {(8, 0), (9, 0), (10, 0), (11, 0), (11, 1), (12, 1)} == set(got)
    assert got[(9, 0)].keep_doc_id == 8 and got[(12, 1)].keep_doc_id == 10 and got[(12, 1)].copies == 4
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got.values():
        assert texts[r.doc_id][r.start:r.end] == texts[r.doc_id].split("\n")[r.para_no]
    assert paragraphs.repeated_paragraphs(no_docs(spark)).count() == 0
    assert paragraphs.without_repeats(edge_docs(spark)).count() == edge_docs(spark).count()


def random_words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def planted(sizes, docs_each, seed):
    """Documents of plain words, without sentences, with a run in the middle: rows, and {doc_id: (start, end, size)}."""
    rng = random.Random(seed)
    runs, rows, want = {n: " ".join(random_words(rng, n)) for n in sizes}, [], {}
    for k in range(docs_each):
        for n, run in runs.items():
            head, tail = (" ".join(random_words(rng, rng.randint(5, 60))) for _ in range(2))
            want[len(rows)] = (len(head) + 1, len(head) + 1 + len(run), n)
            rows.append((len(rows), f"{head} {run} {tail}"))
    return rows, want


def test_runs_cut_at_any_word_are_found(spark):
    """No sentence marks, no capitals, one line: runs of 50 words and more are found wherever they begin."""
    rows, want = planted([50, 51, 55, 60, 90], 6, 12)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = paragraphs.repeated_paragraphs(docs).where("kind = 'passage'").collect()
    assert {r.doc_id for r in got} == set(want)
    assert {r.doc_id for r in got if r.removed} == set(want) - set(range(5))


def test_runs_are_found_to_their_ends(spark):
    """The span is the planted run to the character, and nothing of it is left in the later documents."""
    rows, want = planted([50, 57, 64, 120], 4, 13)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.start, r.end) for r in paragraphs.repeated_paragraphs(docs).where("kind = 'passage'").collect()}
    assert got == {i: (a, b) for i, (a, b, _) in want.items()}
    left = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert all(left[i] == (t if i < 4 else t[:want[i][0]] + t[want[i][1]:]) for i, t in rows)


def test_passages_with_a_changed_word_are_found(spark):
    """A changed word in a passage, in other surroundings: the passage goes from its first equal word to its last."""
    rng = random.Random(21)
    rows, want = [], {}
    for size in (51, 60, 75, 95):
        base = random_words(rng, size)
        for k, at in enumerate((None, size // 2, size // 3)):
            run = list(base)
            if at is not None:
                run[at] = f"edit{size}x{k}"
            head, run, tail = (" ".join(x) for x in (random_words(rng, 30), run, random_words(rng, 30)))
            want[len(rows)] = (len(head) + 1, len(head) + 1 + len(run), len(rows) - k)
            rows.append((len(rows), f"{head} {run} {tail}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = paragraphs.repeated_paragraphs(docs).where("kind = 'passage' and removed").collect()
    for i, (start, end, first) in want.items():
        spans = [(r.start, r.end) for r in got if r.doc_id == i]
        if i == first:
            assert not spans
        else:
            assert (min(s for s, _ in spans), max(e for _, e in spans)) == (start, end)
            assert all(r.keep_doc_id == first for r in got if r.doc_id == i)


def test_short_lines_are_paragraphs(spark):
    """Footers and license lines of 6 words and more, equal or with a changed last word, in other surroundings."""
    rng = random.Random(31)
    footer, license_line = "All rights reserved by the author", " ".join(random_words(rng, 30))
    rows = [(i, "\n".join([" ".join(random_words(rng, 8)), footer if i % 2 else license_line + f" end{i}"])) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = paragraphs.repeated_paragraphs(docs).where("kind = 'paragraph'").collect()
    assert {(r.doc_id, r.para_no, r.keep_doc_id, r.copies) for r in got} == {(i, 1, i % 2, 4) for i in range(8)}
    assert all(r.removed == (r.doc_id > 1) for r in got)


def brute_equal_passages(docs, words):
    """Every window against every other one, neighbours merged."""
    rows = [(i, t or "") for i, t in docs]
    order = lambda i, *rest: (i is not None, i or 0, *rest)
    windows, groups = [], defaultdict(list)
    for i, t in rows:
        spans = [m.span() for m in re.finditer(r"\S+", t)]
        for k in range(len(spans) - words + 1):
            one = (i, t, k, spans[k][0], spans[k + words - 1][1])
            name = tuple(t[one[3]:one[4]].lower().split())
            groups[name].append(one)
            windows.append((name, one))
    runs = defaultdict(list)
    for name, (i, t, k, a, b) in windows:
        if len(groups[name]) > 1:
            keep = min(groups[name], key=lambda w: order(w[0], w[3], w[4]))
            runs[i, t, keep[0], not (i == keep[0] and a < keep[4])].append((a, b, k, k + words, len(groups[name])))
    found = set()
    for (i, _, keep, removed), spans in runs.items():
        merged = []
        for a, b, k, z, n in sorted(set(spans)):
            if merged and a <= merged[-1][1]:
                m = merged[-1]
                merged[-1] = (m[0], max(b, m[1]), m[2], max(z, m[3]), max(n, m[4]))
            else:
                merged.append((a, b, k, z, n))
        found |= {(i, keep, removed, *m) for m in merged}
    return found


def test_equal_windows_match_brute_force(spark):
    """Text that repeats itself, in one row only and in several, other white space, copies, repeated rows, null ids."""
    rng = random.Random(41)
    cycle, shared, twice = (random_words(rng, n) for n in (7, 40, 30))
    plain = lambda n: random_words(rng, n)
    texts = [plain(9) + cycle * 9 + plain(5), plain(4) + twice + plain(8) + twice + plain(3),
             plain(6) + shared + plain(6), plain(3) + shared[5:] + cycle * 4, ["on"] * 70 + shared, ["on"] * 45 + plain(4),
             plain(5) + twice[:25] + plain(2) + shared + plain(3) + shared[:22]]
    rows = [(i + 1, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(20, rows[0][1]), (3, rows[2][1]), (21, rows[3][1].replace(" ", "  ", 9)), (None, rows[4][1]),
             (None, "lead " + rows[6][1]), (22, None), (1, " ".join(shared) + " \n " + " ".join(twice))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for words in (20, 12):
        anchors = paragraphs.passage_anchors(docs, words)
        shared_keys = anchors.groupBy("key").agg(F.count("*").alias("n"), F.max("here").alias("here")).where("n > 1")
        hits = anchors.drop("here").join(shared_keys.select("key", (F.col("n") > F.col("here")).alias("far")), "key")
        got = {(r.doc_id, r.keep_doc_id, r.removed, r.start, r.end, r.first_word, r.end_word, r.copies)
               for r in paragraphs.equal_passages(docs, hits, words).collect()}
        assert got == brute_equal_passages(rows, words)


def test_copies_are_compared_once(spark, monkeypatch):
    """Of equal texts only the windows of one are compared, and text that repeats itself is settled in its row."""
    rng, sizes, saved = random.Random(43), {}, paragraphs._saved

    def counted(df, label):
        table = saved(df, label)
        sizes[label] = table.count()
        return table
    monkeypatch.setattr(paragraphs, "_saved", counted)
    text, cycle = " ".join(random_words(rng, 200)), " ".join(random_words(rng, 9) * 20)
    docs = spark.createDataFrame([(i, text) for i in range(30)] + [(99, cycle)], "doc_id bigint, text string")
    got = {(r.doc_id, r.start, r.end, r.removed) for r in paragraphs.repeated_paragraphs(docs).where("kind = 'passage'").collect()}
    assert {(i, 0, len(text), i > 0) for i in range(30)} <= got and any(r[0] == 99 for r in got)
    assert sizes["passage-windows"] == 200 - 50 + 1
