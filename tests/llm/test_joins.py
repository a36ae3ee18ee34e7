"""Line dedup, n-gram join and decontamination against plain Python."""

import hashlib
import itertools
import re
import tracemalloc

import numpy as np
import pytest

from llm_samples import BENCH, varied_texts
from wardlake.llm import decontaminate, graph, line_dedup, ngram_join, work


def word_set(line):
    return frozenset((line or "").encode().lower().split())


def alike(x, y):
    return 100 * len(x & y) >= 80 * len(x | y)


def plain_line_dedup(rows):
    """Every line against every earlier one."""
    out, seen = {}, []
    for doc_id, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            own = word_set(line)
            if len(own) >= line_dedup.MIN_WORDS:
                if not any(alike(own, x) for x in seen):
                    kept.append(line)
                seen.append(own)
            else:
                kept.append(line)
        out[doc_id] = "\n".join(kept)
    return out


@pytest.mark.parametrize("first_pairs", [1, 8])
def test_line_dedup(spark, make_docs, monkeypatch, first_pairs):
    monkeypatch.setattr(line_dedup, "FIRST_PAIRS", first_pairs)
    texts = varied_texts()
    docs = make_docs(texts, extra=True)
    out, total, taken = line_dedup.dedup(docs)
    got = {r.doc_id: r for r in out.collect()}
    want = plain_line_dedup([(i, t) for i, t in enumerate(texts) if t is not None])
    assert got[0].text is None and got[0][total] == 0
    assert {i: r.text for i, r in got.items() if i} == want
    assert all(r[total] == len(texts[i].split("\n")) for i, r in got.items() if i)
    assert sum(r[taken] for r in got.values()) == sum(len(t.split("\n")) for t in texts if t is not None) - sum(
        r[total] - r[taken] for r in got.values() if r.text is not None)
    assert got[3].margin == "keep" and got[3].n_lines == "keep"


def test_line_dedup_of_short_lines(make_docs):
    lines = ["yes", "a b", "b  A", "a b c", "a b c d", "d c b a e", "a b c d f", "a b c x", "你好你好你好", "yes yes", "a b a b a b", "你好你好你好", " ", "", " ",
             "v w x y z", "v w x y", "w x y z", "x y z", "z y x"]
    texts = ["\n".join(lines[i:i + 4]) for i in range(0, len(lines), 4)] + ["yes\nno", "no"]
    want, seen = {}, []
    for i, text in enumerate(texts):
        kept = []
        for line in text.split("\n"):
            own = word_set(line)
            if not own or not any(alike(own, x) for x in seen):
                kept.append(line)
            seen += [own] if own else []
        want[i] = "\n".join(kept)
    out, _, _ = line_dedup.dedup(make_docs(texts))
    assert {r.doc_id: r.text for r in out.collect()} == want
    assert want[6] == "" and want[1] == "a b c d\na b c x"


def test_line_dedup_without_ids_and_of_nothing(spark, make_docs):
    line = "six words stand in this line"
    docs = make_docs([line, line, line, None], [None, 1, 2, None])
    kept = line_dedup.stage(spark, docs, "")
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("1", line), ("None", "None"), ("None", line)]
    assert line_dedup.stage(spark, make_docs([]), "").count() == 0


def test_line_dedup_joins_few_pairs_that_are_no_links(make_docs, monkeypatch):
    """Long lines with ten rare words in common, unlike otherwise: none of the 900 pairs is a link."""
    rng, saved, save = np.random.default_rng(8), {}, line_dedup.work.save

    def note(df, label):
        out = save(df, label)
        saved[label] = saved.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(line_dedup.work, "save", note)
    texts = [" ".join([f"rare{i // 10}x{k}" for k in range(10)] + [f"w{k}" for k in rng.choice(1000, 150, replace=False)]) for i in range(200)]
    out, _, taken = line_dedup.dedup(make_docs([*texts, texts[7], texts[7] + " more"]))
    assert {r.doc_id for r in out.collect() if r[taken]} == {200, 201}
    assert 1 <= saved["line-pairs"] < 50


def test_line_dedup_shuffles_texts_alike_at_every_size(make_docs):
    out, _, _ = line_dedup.dedup(make_docs(["one two three four five", "one two three four five"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan


def index_entries(n_lines):
    rng = np.random.default_rng(5)
    data = "\n".join(" ".join(f"w{k}" for k in row) for row in rng.integers(0, 50_000, (n_lines, 24))).encode()
    ranks = np.arange(1 << work.SKETCH_BITS, dtype=np.uint32)
    lines = line_dedup.read_lines(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ranks)
    return line_dedup._dealt(line_dedup.entries(lines, np.zeros(1, np.int64)), np.ones(1 << work.SKETCH_BITS, np.int64))


def test_index_entries_are_packed_without_a_second_copy():
    e = index_entries(60_000)
    size = sum(v.nbytes for v in e.values())
    assert len(e["word"]) > 4 * line_dedup._SORTED_ENTRIES
    tracemalloc.start()
    sent = sum(len(blob) for _, blob in line_dedup._pack_entries(e, 64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sent > size / 3 and peak < size


def test_packed_index_entries_come_back_whole():
    e, parts = index_entries(20_000), 50
    part = line_dedup._group(e) % np.uint64(parts)
    packed = list(line_dedup._pack_entries(e, parts))
    assert [p for p, _ in packed] == np.unique(part).tolist()
    for p, blob in packed:
        got = line_dedup._unpack_entries(blob)
        assert all((got[k] == e[k][part == p]).all() for k, _ in line_dedup._ENTRY)
    batches = list(line_dedup._batches(iter(packed)))
    assert [x for b in batches for x in b.column(1).to_pylist()] == [blob for _, blob in packed]
    assert len(batches) > 1 and max(b.nbytes for b in batches) < line_dedup._SENT_BYTES + 2 * max(len(x) for _, x in packed)


def test_line_dedup_reads_texts_in_small_batches(spark, make_docs, monkeypatch):
    name, seen, save = "spark.sql.execution.arrow.maxBytesPerBatch", {}, line_dedup.work.save

    def note(df, label):
        seen[label] = spark.conf.get(name)
        return save(df, label)

    monkeypatch.setattr(line_dedup.work, "save", note)
    before = spark.conf.get(name)
    line_dedup.dedup(make_docs(["one two three four five", "one two three four five six"]))
    assert {"line-found", "line-sets"} <= set(seen) and set(seen.values()) == {f"{1 << 22}b"}
    assert spark.conf.get(name) == before
    try:
        for own, meant in (("1m", 1 << 20), ("64MB", 1 << 22), ("5000000", 1 << 22)):
            spark.conf.set(name, own)
            with work.small_batches(spark):
                assert spark.conf.get(name) == f"{meant}b"
            assert spark.conf.get(name) == own
    finally:
        spark.conf.set(name, before)


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        if sets[i] and sets[j] and alike(sets[i], sets[j]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("block", [4, 512])
def test_ngram_join(make_docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = varied_texts()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(make_docs(texts, extra=True)).collect()}
    want = plain_components(enumerate(texts))
    assert got == want
    assert len({c for _, c in want.values()}) < len(texts) - 10


def test_regions_recurse_exactly(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 10**6, 60, dtype=np.uint64)
    members = []
    for i in range(150):
        own = base.copy() if i % 2 else rng.integers(0, 10**6, 60, dtype=np.uint64)
        own[rng.choice(60, i % 9, replace=False)] = rng.integers(10**6, 10**7, i % 9, dtype=np.uint64)
        members.append(np.unique(own))
    monkeypatch.setattr(ngram_join, "LEAF", 4)
    label = ngram_join.join_region(members)
    parent = list(range(150))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [set(m.tolist()) for m in members]
    for i, j in itertools.combinations(range(150), 2):
        if alike(sets[i], sets[j]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    assert label.tolist() == [find(i) for i in range(150)]
    counts = np.stack([ngram_join.cell_counts(m) for m in members])
    keep = ngram_join.possible(counts, np.array([len(m) for m in members]))
    assert all(keep[i] for i in range(150) if any(alike(sets[i], sets[j]) for j in range(150) if j != i))


def test_ngram_stage_keeps_one_of_each_group(spark, make_docs):
    text = "one two three four five six seven"
    docs = make_docs([text, text, text, "", "", None, "other words"], [5, 3, None, 8, 9, None, 4], extra=True)
    out = ngram_join.stage(spark, docs, "")
    assert sorted(str(r.doc_id) for r in out.collect()) == ["3", "4", "8", "9", "None", "None"]
    assert out.columns == docs.columns
    assert ngram_join.join(make_docs([])).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def plain_decontaminate(rows, items):
    def split(text):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())

    windows = {}
    for item, text in items:
        w = split(text)
        n = min(len(w), 10)
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).add(item)
    out = {}
    for doc_id, text in rows:
        w = split(text)
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if found := windows.get(tuple(w[a:a + n])):
                    hit |= set(range(a, a + n))
                    names |= found
        joined = ",".join(sorted(names))
        out[doc_id] = (len(w), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))
    return out


def test_decontaminate(spark, make_docs):
    texts = varied_texts()
    long = texts[20].split()
    items = [("i1", " ".join(long[:25])), ("i2", " ".join(long[3:14])), ("i3", "One"), ("i4", None), ("i5", ""), ("i10", " ".join(texts[-2].split()[40:90])),
             ("i1b", " ".join(long[:25])), ("i6", "never seen words here"), ("i7", "a B, c"), ("i7", "a B, c")]
    bench = spark.createDataFrame(items, BENCH)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(make_docs(texts, extra=True), bench).collect()}
    assert got == plain_decontaminate(enumerate(texts), items)
    assert sum(v[4] for v in got.values()) > 10
    none = decontaminate.report(make_docs(texts), spark.createDataFrame([], BENCH))
    assert none.where("contaminated").count() == 0 and none.count() == len(texts)
    assert decontaminate.report(make_docs([]), bench).count() == 0


def test_proximity_matches(spark, make_docs):
    phrase = [f"term{i}" for i in range(12)]
    loose = " ".join(x + (" filler" if i % 3 == 1 else "") for i, x in enumerate(phrase))
    bench = spark.createDataFrame([("i", " ".join(phrase))], BENCH)
    got = {r.doc_id: r for r in decontaminate.report(make_docs([loose, " ".join(phrase), "term3 alone"]), bench).collect()}
    assert (got[0].n_hit, got[0].n_near_items) == (0, 1)
    assert (got[1].n_hit, got[1].n_near_items) == (12, 1)
    assert (got[2].n_hit, got[2].n_near_items) == (0, 0)


def test_proximity_matches_against_brute_force(spark, make_docs, tables):
    from wardlake.llm import registered

    phrase = [f"term{i}" for i in range(12)]
    rng = np.random.default_rng(4)
    texts = [" ".join(phrase[:4] + ["gap"] * g + phrase[4:8] + ["gap"] * h + phrase[8:]) for g in range(0, 13) for h in (0, 3, 6)]
    texts += [" ".join(["pad"] * p + [phrase[0], *["gap"] * 5, *phrase[1:]]) for p in range(9)]
    texts += [" ".join(rng.choice([*phrase, "gap", "pad"], 40)) for _ in range(30)]
    items = {"i": phrase, "j": phrase[:6][::-1] + ["x"] * 3}
    docs, bench = make_docs(texts), spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], BENCH)
    ranks = decontaminate._ranks(docs)
    terms = {r.item_id: r for r in decontaminate._items(bench, ranks).collect()}
    want = {}
    for i, text in enumerate(texts):
        found = []
        for k, words in items.items():
            leads = terms[k].leads
            at = [(p - q, q) for q in leads for p, w in enumerate(text.split()) if w == words[q]]
            best = max((len({q for s, q in at if low <= s <= low + decontaminate.SLACK}) for low, _ in at), default=0)
            found += [k] if best >= decontaminate.LEADS and 2 * best >= len(leads) else []
        want[i] = (len(found), ",".join(found))
    folder = tables(documents=docs, benchmark=bench)
    rows = registered.QUERIES["op10_decontaminate_near"](spark, folder).collect()
    assert {r.doc_id: (r.n_near_items, r.near_items) for r in rows} == want
    assert 5 < sum(v[0] > 0 for v in want.values()) < len(want)


def test_contaminated_documents_go(spark, make_docs, tables):
    phrase = " ".join(f"term{i}" for i in range(12))
    folder = tables(benchmark=spark.createDataFrame([("i", phrase)], BENCH))
    docs = make_docs(["clean text", f"before {phrase} after", None, phrase], [1, 2, 3, None], extra=True)
    out = decontaminate.stage(spark, docs, folder)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3"]
    assert out.columns == docs.columns
