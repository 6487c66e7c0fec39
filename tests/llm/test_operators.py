"""Each operator against a brute-force version, and on empty, null, tied and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, near_dup, warc
from tidemark.llm.ann import nearest
from tidemark.llm.common import components, table
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.line_dedup import line_report, without_repeated_lines
from tidemark.llm.mixing import mix
from tidemark.llm.near_dup import least_matches, near_duplicates
from tidemark.llm.pii import personal_data, sanitised
from tidemark.llm.quality import quality_scores
from tidemark.llm.sharding import minimax_shards, shard_documents
from tidemark.llm.url_filter import url_verdicts

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, source="s"):
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """Extra columns under names that the operators use inside."""
    names = ("words", "pos", "line", "doc", "size", "shard", "block", "queue", "print", "base", "key", "kind", "top", "_id", "label", "tokens", "host", "vector", "row")
    return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(n))


# 1 nearest neighbours


def test_nearest_matches_brute_force(spark):
    df = table(spark, DATA, "embeddings")
    rows = df.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    got = {}
    for r in nearest(clashing(df), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        other = ids != q
        best = np.lexsort((ids[other], -score[other]))[:20]
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert all(abs(s - score[ids == v][0]) < 1e-9 for _, v, s in found)
        hit += len(set(ids[other][best]) & {v for _, v, _ in found})
        total += len(best)
    assert hit / total >= 0.9


def test_nearest_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [1.0, 0.0]), (3, [1.0, 0.0]), (4, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [0.5, 1.0]), (None, [1.0, 1.0]), (11, [1.0]), (3, [1.0, 0.0]), (12, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(3, 1.0), (5, 1.0), (10, 0.5)]
    assert nearest(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert nearest(df.where("vec_id = 4"), F.col("vec_id") == 4).count() == 0


# 2 mixing


def test_mix_places_every_document_once(spark):
    docs = table(spark, DATA, "documents").limit(0).unionByName(table(spark, "/root/testdata/sf0.01", "documents"))
    rows = mix(clashing(docs), block=2).orderBy("position").collect()
    assert len(rows) == docs.count() == len({r.position for r in rows})
    had: dict = {}
    weights = {r.queue: r.weight for r in rows}
    for r in (r for r in rows if r.in_mix):
        had[r.queue] = had.get(r.queue, 0) + 1
        done = r.position + 1
        assert all(abs(had.get(q, 0) - w * done) < 2 for q, w in weights.items())
    inside = [r.position for r in rows if r.in_mix]
    assert inside == list(range(len(inside)))


def test_mix_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a", None, None, 1), (2, "b", None, "", 1), (None, None, None, "x", None), (2, "b", None, "", 1)], DOCS)
    assert mix(docs).count() == 4
    assert mix(docs, weights={"x": 1.0}).count() == 1
    assert mix(docs.limit(0)).count() == 0


# 3 sharding


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, fill = (low + high) // 2, 1, 0
        for s in sizes:
            if fill + s > mid:
                used, fill = used + 1, 0
            fill += s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed", [1, 2])
def test_shards_have_the_least_capacity(spark, seed):
    rng = random.Random(seed)
    rows = [(f"g{rng.randint(0, 60):03}", i, rng.randint(1, 900)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, id long, bytes long")
    got = minimax_shards(df, "g", "bytes", "id", 5).collect()
    groups: dict = {}
    for g, _, size in rows:
        groups[g] = groups.get(g, 0) + size
    load, of_group, slots = [0] * 5, {}, [[] for _ in range(5)]
    for r in got:
        load[r.shard] += r.bytes
        slots[r.shard].append(r.slot)
        assert of_group.setdefault(r.g, r.shard) == r.shard
    assert max(load) == least_capacity([groups[g] for g in sorted(groups)], 5)
    assert [of_group[g] for g in sorted(groups)] == sorted(of_group.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_shards_of_odd_texts(spark):
    texts = [None, "", "é", "a", "a", None, "x" * 200_000]
    rows = shard_documents(clashing(docs_of(spark, texts)), 8).orderBy("doc_id").collect()
    assert [r.size for r in rows] == [1, 1, 3, 2, 2, 1, 200_001]
    assert [r.text_crc32 for r in rows] == [zlib.crc32((t or "").encode()) for t in texts]
    assert rows[3].shard == rows[4].shard and rows[0].shard == rows[5].shard
    assert shard_documents(docs_of(spark, []), 8).count() == 0


# 4 line dedup


def removed_by_force(texts):
    seen, out = [], []
    for text in texts:
        gone = []
        for n, line in enumerate([] if text is None else text.split("\n")):
            words = set(line.lower().split())
            if not words:
                continue
            if any(10 * len(words & w) >= 8 * len(words | w) for w in seen):
                gone.append(n)
            seen.append(words)
        out.append(",".join(map(str, gone)))
    return out


def test_lines_match_brute_force(spark):
    rng = random.Random(4)
    base = [prose(rng, rng.randint(1, 30)) for _ in range(25)]
    texts = [None, "", "\n\n", " ", base[0], base[0].upper()]
    for _ in range(50):
        lines = []
        for line in rng.choices(base, k=rng.randint(1, 6)):
            words = line.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = prose(rng, 1)
            lines.append(" ".join(words))
        texts.append("\n".join(lines))
    docs = docs_of(spark, texts)
    rows = line_report(clashing(docs)).orderBy("doc_id").collect()
    assert [r.removed for r in rows] == removed_by_force(texts)
    assert [r.n_lines for r in rows] == [0 if t is None else t.count("\n") + 1 for t in texts]
    kept = without_repeated_lines(docs).orderBy("doc_id").collect()
    for r, text, k in zip(rows, texts, kept):
        gone = set(r.removed.split(",")) - {""}
        want = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if str(n) not in gone)
        assert k.text == want
    assert line_report(docs.limit(0)).count() == 0


def test_long_unlike_lines_are_hardly_compared(spark, monkeypatch):
    rng = random.Random(9)
    names = [f"w{i}" for i in range(400)]
    lines = [rng.sample(names, 180) for _ in range(60)]
    # Near copies over a border of size bands, in both orders, and one of lines removed themselves.
    for i in (0, 1, 2):
        lines.append(lines[i] + [f"x{i}-{k}" for k in range(40)])
        lines.append(lines[i][:-30])
    texts = [" ".join(line) for line in lines]
    compared = []
    whole = line_dedup.verified

    def counting(docs, pairs):
        compared.append(pairs.count())
        return whole(docs, pairs)

    monkeypatch.setattr(line_dedup, "verified", counting)
    rows = line_report(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.removed for r in rows] == removed_by_force(texts)
    assert sum(map(len, removed_by_force(texts))) == 6
    assert sum(compared) < 60


# 5 decontamination


def test_leaks_exact_near_and_clean(spark):
    rng = random.Random(5)
    items = [prose(rng, n) for n in (5, 9, 16, 38, 59, 300)] + ["too short", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts, want = [], set()
    for n, item in enumerate(items[:6]):
        words = item.split()
        texts.append(f"{prose(rng, 40)} {item.upper().replace(' ', ', ')}. {prose(rng, 40)}")
        want.add((len(texts) - 1, n))
        texts.append(item)
        want.add((len(texts) - 1, n))
        if len(words) >= 38:
            near = [*words[:20], "changed", *words[21:]]
            texts.append(f"{prose(rng, 30)} {' '.join(near)} {prose(rng, 30)}")
            want.add((len(texts) - 1, n))
        texts.append(" ".join(words[: len(words) // 2]) + " " + prose(rng, 60))
    texts += [None, "", "too short", prose(rng, 30_000), prose(rng, 30_000) + " " + items[3]]
    want.add((len(texts) - 1, 3))
    docs = docs_of(spark, texts)
    got = contaminated(clashing(docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(r.similarity >= 0.8 for r in got)
    in_passes = contaminated(docs, bench, pass_words=10).collect()
    assert sorted(map(tuple, in_passes), key=str) == sorted(map(tuple, got), key=str)
    assert contaminated(docs, bench.limit(0)).count() == contaminated(docs.limit(0), bench).count() == 0


# 6 personal data


def test_personal_data_spans_and_disclosing_terms(spark):
    texts = [
        "write to Ann.Lee@mail.example.com, deputy Harbourmaster, 10.0.0.256 10.0.0.1",
        "the Harbourmaster (ann.lee@mail.example.com) called +1 (555) 123-4567 é 4111 1111 1111 1111",
        "a deputy of the town", "nothing here", None, "", "4111 1111 1111 1112 a@b +12 1.2.3",
        "x" * 50_000 + "@" + "y.z" + " 1" * 20_000,
    ]
    docs = docs_of(spark, texts)
    rows = personal_data(clashing(docs)).orderBy("doc_id").collect()
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows[:7]] == [(1, 1, 0, 0), (1, 0, 1, 1), *[(0, 0, 0, 0)] * 5]
    assert rows[7].n_email == 1
    found = dict((s.split(":")[0], texts[0][int(s.split(":")[1]) : int(s.split(":")[2])]) for s in rows[0].spans.split(","))
    assert found == {"email": "Ann.Lee@mail.example.com", "removed": "Harbourmaster", "ip": "10.0.0.1"}
    assert [r.spans for r in rows[2:7]] == [""] * 5
    clean = [r.text for r in sanitised(docs).orderBy("doc_id").collect()]
    assert clean[0] == "write to [EMAIL], deputy , 10.0.0.256 [IP]"
    assert clean[1] == "the  ([EMAIL]) called [PHONE] é [CARD]"
    assert clean[2:7] == texts[2:7]
    assert personal_data(docs.limit(0)).count() == 0


def test_terms_far_from_a_mention_and_at_all_their_places(spark):
    far = " filler" * 40
    texts = [f"Bo runs it.{far} bo@mail.example.com{far} ask bo, (Bo)", f"ann and Bo.{far} BO@mail.example.com"]
    texts += ["filler mail example com and it ask runs"] * 3 + [f"other {i}" for i in range(20)]
    docs = docs_of(spark, texts)
    rows = personal_data(docs).orderBy("doc_id").collect()
    marked = [[(m.kind, t[m.start : m.stop]) for m in r.marks] for r, t in zip(rows, texts)]
    assert marked[0] == [("removed", "Bo"), ("email", "bo@mail.example.com"), ("removed", "bo"), ("removed", "Bo")]
    assert marked[1] == [("removed", "Bo"), ("email", "BO@mail.example.com")]
    assert not any(marked[2:])


def test_entities_of_the_same_documents_count_as_one_and_long_texts_end(spark):
    listed = " ".join(f"{i}: user{i}@mail.example.com word{i}" for i in range(5_000))
    docs = docs_of(spark, [listed, "copy " + listed, "plain words mail example com"] + [f"other {i}" for i in range(10)])
    rows = personal_data(clashing(docs)).orderBy("doc_id").collect()
    assert [r.n_email for r in rows[:3]] == [5_000, 5_000, 0]
    assert all(sum(m.kind == "removed" for m in r.marks) == 5_000 for r in rows[:2])
    assert rows[2].spans == ""


# 7 near duplicates


def components_by_force(texts, width, percent):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return [len(s) for s in sets], root


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, width, percent, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK_DOCS", 16)  # groups of several chunks
    rng = random.Random(7)
    texts = [None, "", " ", "one", "ONE", "one two", "a b c"]
    for _ in range(6):
        base = prose(rng, rng.randint(40, 200)).split()
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 7)):
                words[rng.randrange(len(words))] = prose(rng, 1)
            texts.append(" ".join(words))
        texts += [" ".join(base)] * 3
    texts.append(prose(rng, 20_000))
    got = near_duplicates(clashing(docs_of(spark, texts)), width, percent).orderBy("doc_id").collect()
    sizes, roots = components_by_force(texts, width, percent)
    assert [r.n_shingles for r in got] == sizes
    assert [r.component_id for r in got] == roots
    assert [r.kept for r in got] == [r == i for i, r in enumerate(roots)]


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "a b c d", None, None, None), (4, "a b c d", None, None, None), (4, "e f g h", None, None, None), (9, "e f g h", None, None, None), (9, "e f g h", None, None, None)]
    got = near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (4, 4, True), (4, 4, True), (9, 4, False), (9, 4, False)]
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_pruning_keeps_all_but_the_chosen_miss():
    keep = least_matches(0.85, 1e-4)
    rng = np.random.default_rng(1)
    agree = (rng.random((200_000, 100)) < 0.85).cumsum(axis=1)[:, 19::20]
    assert ((agree < np.array(keep)).any(axis=1)).mean() < 1e-3


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(500, 501)], "a long, b long")
    roots = dict(components(edges, "test").collect())
    assert {roots[i] for i in range(300)} == {0} and roots[501] == 500


# 8 quality


def test_quality_on_held_out_rows(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    scored = quality_scores(docs, labels).where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in scored) / len(scored)
    kept = [r.predicted for r in scored if r.quality == 1]
    assert len(scored) > 500 and right >= 0.95 and sum(kept) / len(kept) >= 0.97
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)


def test_quality_of_odd_tables(spark):
    docs = clashing(docs_of(spark, [None, "", "good words", "x" * 100_000, "bad !! bad !!"]))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_scores(docs, none).collect()} == {1.0}
    one = spark.createDataFrame([(4, 0, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_scores(docs, one).collect()} <= {0.0, 1.0}
    two = spark.createDataFrame([(i, i % 2, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    assert quality_scores(docs, two).count() == 5
    assert quality_scores(docs.limit(0), two).count() == 0


# 9 WARC


def test_archive_round_trip(spark, tmp_path):
    long = "".join(random.Random(9).choices("aé\r\n<", k=60_000))
    html = ["<p>hi</p>", long, long, None, "", "\r\n\r\nWARC/1.1\r\n\r\n", "z" * 1000, "z" * 1000, "z" * 999, "z" * 999, "<p>hi</p>"]
    rows = [(i, f"http://h/{i}\n", h) for i, h in enumerate(html)] + [(None, None, "q" * 2000), (2, "again", long)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    path = str(tmp_path / "arc")
    warc.write_archive(pages, path, segment=500)
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    by_id = {r.page_id: r for r in got}
    assert by_id[1].kind == "revisit" and by_id[1].refers_to == 2 and by_id[2].kind == "response"
    assert (by_id[6].kind, by_id[6].refers_to, by_id[7].kind) == ("revisit", 7, "response")
    assert by_id[8].kind == by_id[9].kind == by_id[0].kind == by_id[10].kind == "response"
    for i, h in enumerate(html):
        assert by_id[i].payload_bytes == len((h or "").encode())
    warc.write_archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_broken_segments_are_told(spark, tmp_path):
    row = {"payload": b"p" * 3000, "kind": "response", "record": "7", "page_id": 7, "url": "http://h/", "refers_to": None}
    records = [r + b"\r\n\r\n" for r in warc.records_of(row, 1000)]
    assert len(records) > 3
    for name, part in (("missing", records[:1] + records[2:]), ("swapped", records[::-1]), ("plain", records)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(b"".join(part))
    read = lambda name: warc.read_archive(spark, str(tmp_path / name)).collect()
    assert [(r.intact, r.payload_bytes) for r in read("missing")] == [(False, None)]
    assert [(r.intact, r.payload_bytes) for r in read("swapped")] == [(True, 3000)] == [(r.intact, r.payload_bytes) for r in read("plain")]


def test_chunk_framing():
    for size in (0, 1, 4095, 4096, 9000):
        body = bytes(random.Random(size).choices(range(256), k=size))
        assert warc.unchunked(warc.chunked(body)) == body
    for broken in (b"", b"5\r\nab", b"2\r\nabX\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


# 10 URL verdicts


def linked_pages(spark):
    link = lambda *hosts: " ".join(f'<a href="https://{h}/x">' for h in hosts)
    rows = [
        (1, "http://bad.net/a", link("victim.info")), (2, "http://friend.info/", link("bad.net", "BAD.net", "worse.net")),
        (3, "http://good.org/fr/1", link("neutral.info")), (4, "http://neutral.info/", ""),
        (5, "http://EXAMPLE.net/en/x?q", None), (6, "http://sub.example.net/de/", ""), (7, "http://a.example.com/de/", ""),
        (8, "http://a.example.com/en/", ""), (9, "http://worse.net/", link("friend.info")), (10, "nourl", ""), (11, None, None),
        (12, "http://plain.net", ""), (13, "http://victim.info/fr/#x", link("good.org")), (14, "http://good.org/en", link("neutral.info")),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_url_verdicts(spark):
    got = {r.page_id: r for r in url_verdicts(clashing(linked_pages(spark))).collect()}
    assert (got[1].rule, got[1].verdict) == ("net/", "block")
    assert (got[5].host, got[5].rule, got[5].verdict) == ("example.net", "example.net/en/", "allow")
    assert (got[6].rule, got[7].rule, got[8].rule) == ("net/", "example.com/de/", None)
    assert got[2].verdict == "block"  # links to blocked hosts only
    assert got[4].verdict == got[14].verdict == "allow"
    assert (got[12].host, got[12].path, got[12].rule) == ("plain.net", "", None)
    assert [(got[i].host, got[i].path, got[i].verdict) for i in (10, 11)] == [("", "", "allow")] * 2
    assert url_verdicts(linked_pages(spark).limit(0)).count() == 0
