import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import SF, as_rows

from strataflow.llm import jaccard, reshard, warc
from strataflow.llm.common import written

from test_text_operators import words


# ---------------------------------------------------------------- WARC

def expected_pages(rows):
    payload = lambda h: (h or "").encode()
    first = {}
    for k, _, h in rows:
        if k is not None and len(payload(h)) >= 100:
            first[payload(h)] = min(first.get(payload(h), k), k)
    out = []
    for k, _, h in rows:
        p = payload(h)
        to = first.get(p)
        revisit = to is not None and to != k and sum(payload(x) == p for _, _, x in rows) > 1
        out.append((str(k), len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", str(to) if revisit else "None"))
    return sorted(out)


def page_rows():
    big = "<p>" + "long enough to be worth a revisit " * 10
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(0, "http://a/0", big), (3, "http://a/3", big), (2, None, big), (1, "bad\r\nWARC/1.1\r\nurl", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (None, "u", big), (None, "u", "x" * 150)]
    rows += [(100 + k, f"http://t/{k}", trap * k) for k in range(1, 40)] + [(200, "u", "é日🙂\r\n\r\n" * 3000), (201, "u", "WARC/1." * 5000), (202, "u", "\r\n\r\nWARC/1.1\r\n"), (7, "u", big + "7"), (7, "u", big + "7")]
    return rows


@pytest.mark.parametrize("split", ["134217728", "700", "4096"])
def test_archives_come_back_whole(spark, split):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string").repartition(2)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        out = warc.warc_round_trip(pages).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in out) == expected_pages(rows)


def test_only_reachable_records_count(spark, tmp_path):
    record = lambda body, n=None: f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <x>\r\nContent-Length: {len(body) if n is None else n}\r\n\r\n{body}\r\n\r\n"
    inner = record("inner")
    (tmp_path / "a.warc").write_bytes((record(inner) + record("two")).encode())
    (tmp_path / "b.warc").write_bytes(b"garbage" + record("lost").encode())
    (tmp_path / "c.warc").write_bytes((record("ok") + record("broken", 3) + record("after")).encode())
    out = warc.read_warc(spark, str(tmp_path)).collect()
    got = sorted((r.file[-6:], bytes(r.block).decode()) for r in out)
    assert got == [("a.warc", inner), ("a.warc", "two"), ("c.warc", "bro"), ("c.warc", "ok")]


def test_headers_may_be_longer_than_blocks(spark):
    rows = [(k, f"data:{k}," + "u" * 100_000 if k % 7 == 3 else f"http://a/{k}", f"{k} " + "text\r\n\r\n" * 300) for k in range(60)]
    rows += [(100, "data:," + "WARC/1.1" * 20_000, "magic words in a long url"), (101, None, "after it")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        out = warc.warc_round_trip(pages).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in out) == expected_pages(rows)


def test_a_foreign_header_may_be_long_and_hold_magic_words(spark, tmp_path):
    record = lambda body, uri: f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
    bodies = ["one", "two", "three"]
    (tmp_path / "a.warc").write_bytes("".join(map(record, bodies, ["u" * 100_000, "WARC/1.0" * 20_000, "u"])).encode())
    assert sorted(bytes(r.block).decode() for r in warc.read_warc(spark, str(tmp_path)).collect()) == sorted(bodies)


def test_urls_of_a_million_characters(spark):
    rows = [(k, "data:," + "u" * 10**6 if k in (3, 17) else f"http://a/{k}" + "v" * (10**5 if k == 9 else 0), f"page {k}") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for split in ("134217728", "65536"):
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            out = warc.warc_round_trip(pages).collect()
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
        assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in out) == expected_pages(rows)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None  # the session is left as it was


def test_broken_chains_are_told(spark, tmp_path):
    record = lambda body, n=None: f"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: {len(body) if n is None else n}\r\n\r\n{body}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes((record("fine") + record("too")).encode())
    assert warc.read_warc(spark, str(tmp_path), broken="raise").count() == 2
    (tmp_path / "b.warc").write_bytes(b"garbage" + record("lost").encode())
    (tmp_path / "c.warc").write_bytes((record("ok") + record("broken", 3) + record("after")).encode())
    marks = {r.file[-6:]: r.offset for r in warc.read_warc(spark, str(tmp_path), broken="mark").where("record_type = 'broken'").collect()}
    assert marks == {"b.warc": 0, "c.warc": len(record("ok")) + len(record("bro", 3))}
    with pytest.raises(ValueError, match="chains of records break"):
        warc.read_warc(spark, str(tmp_path), broken="raise")


def test_blocks_may_be_read_in_groups(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").repartition(5)
    warc.write_warc(warc.with_revisits(pages), str(tmp_path / "w"))
    a = warc.payloads(warc.read_warc(spark, str(tmp_path / "w")))
    b = warc.payloads(warc.read_warc(spark, str(tmp_path / "w"), blocks_at_once=2))
    assert as_rows(a.columns, a.collect()) == as_rows(b.columns, b.collect()) and a.count() == len(page_rows())


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.warc_round_trip(pages).count() == 0


# ---------------------------------------------------------------- Jaccard join

def brute_links(rows):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)]) if w else t or "")
    n, parent = len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = Counter()
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = a == b
            if not same and isinstance(a, frozenset) and isinstance(b, frozenset):
                shared = len(a & b)
                same = 5 * shared >= 4 * (len(a) + len(b) - shared)
            if same:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(k)] = min(least.get(root(k), doc), doc)
    return sorted((str(rows[k][0]), str(least.get(root(k))), links[k]) for k in range(n))


def near_rows():
    from llm_support import prose

    rows = [(100 + k, prose(k, 80)) for k in range(20)]
    base = prose(500, 120).split(" ")
    for k in range(40):  # a large group of near copies, each with a word of its own, in a chain of changes
        copy = list(base)
        copy[(7 * k) % len(copy)] = f"own{k}"
        rows.append((300 - k, " ".join(copy)))
    rows += [(1, prose(3, 80)), (2, prose(3, 80).upper()), (3, prose(3, 80).replace(" ", ", ")), (4, None), (5, ""), (6, "!!"), (7, "??"), (8, "!!"), (9, "one two"), (10, "One, two."), (11, "two one")]
    return [*rows, (None, prose(3, 80)), (None, "only without id"), (12, prose(500, 120)), (12, prose(500, 120)), (13, prose(8, 30_000)), (14, prose(8, 30_000) + " end")]


@pytest.mark.parametrize("tile", [128, 3])
def test_links_and_classes_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = near_rows()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, class_id string").repartition(4)
    out = jaccard.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in out) == brute_links(rows)


def test_large_buckets_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 4)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(jaccard, "SIDE", 7)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = jaccard.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in out) == brute_links(rows)


def test_near_copies_that_share_ids_equal_brute_force(spark):
    from llm_support import prose

    base, rows = prose(700, 100).split(" "), []
    for k in range(60):  # neighbours in the chain are alike, far ones are not; ids repeat with each kind
        base[(5 * k) % len(base)] = f"own{k}"
        rows.append((k % 4, " ".join(base)))
    rows += [rows[7], (2, None), (2, ""), (None, rows[9][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = jaccard.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in out) == brute_links(rows)


def test_near_duplicates_of_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = jaccard.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in out) == brute_links([tuple(r) for r in docs.collect()])


def test_no_documents_to_join(no_docs):
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_bands_reach_the_recall():
    b = jaccard.choose_bands(0.8, 5, 0.998)
    assert 1 - (1 - 0.8**5) ** b >= 0.998 > 1 - (1 - 0.8**5) ** (b - 1)


def test_chains_of_components_merge(spark):
    chain = [(f"c{k}", n) for k in range(50) for n in (k, k + 1)] + [("x", 900), ("x", 901), ("y", 902)]
    df = spark.createDataFrame([(hash(c), (n * 7919) % 1009) for c, n in chain], "comp long, node long")
    labels = {r.node: r.label for r in jaccard.merge_components(df).collect()}
    assert len({labels[(n * 7919) % 1009] for n in range(51)}) == 1 and len(set(labels.values())) == 3


# ---------------------------------------------------------------- resharding

def test_flow_is_cheapest():
    draw = np.random.default_rng(2)
    for _ in range(30):
        n, m = draw.integers(1, 5, 2)
        supply = draw.integers(0, 50, n)
        capacity = draw.integers(0, 50, m)
        capacity[0] += max(0, supply.sum() - capacity.sum())
        cost = draw.integers(0, 4, (n, m)).astype(float)
        flow = reshard.min_cost_flow(supply, capacity, cost)
        assert (flow.sum(1) == supply).all() and (flow.sum(0) <= capacity).all() and (flow >= 0).all()
        # no cheaper flow: the residual graph has no negative cycle
        dist = np.zeros(n + m)
        for _ in range(n + m + 1):
            before = dist.copy()
            for i in range(n):
                for j in range(m):
                    dist[n + j] = min(dist[n + j], dist[i] + cost[i, j])
                    if flow[i, j] > 0:
                        dist[i] = min(dist[i], dist[n + j] - cost[i, j])
        assert (dist == before).all()
    with pytest.raises(ValueError):
        reshard.min_cost_flow(np.array([2]), np.array([1]), np.zeros((1, 1)))


def test_kept_bytes_stay(spark):
    sizes = {(s, b): 10 for s in range(5) for b in range(160)}
    plan = reshard.plan_transfers(sizes, 5, 8)
    held = Counter()
    for key, shard in plan.target.items():
        held[shard] += sizes[key]
    assert set(held.values()) == {1000} and plan.moved == 3000
    assert reshard.plan_transfers({}, 5, 8).moved == 0


def test_layout(spark, odd_docs, no_docs):
    out = reshard.shard_digests(odd_docs).collect()
    text = {}
    for r in odd_docs.collect():
        text.setdefault(r.doc_id, []).append((len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())))
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append((r.size, r.text_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in text.items()}
    for shard in range(8):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert reshard.shard_digests(no_docs).count() == 0


def test_placement_equals_brute_force(spark):
    """Shards, blocks and slots again by hand from the rows' sizes and hashes, through the same flow."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(None, None), (7, ""), (7, "")], "doc_id long, text string"))
    spread = F.xxhash64(F.lit(5), "doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")), reshard.text_size())
    rows = [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), r.h) for r in docs.withColumn("h", spread).collect()]
    bins = Counter()
    for _, size, _, _ in rows:
        bins[size.bit_length() - 1] += size
    cut = max(bins)
    while cut >= 0 and 4 * sum(v for k, v in bins.items() if k >= cut) <= sum(bins.values()):
        cut -= 1
    half, old, block = reshard.BLOCKS // 2, {}, {}
    for k, (_, size, _, h) in enumerate(rows):
        old[k] = h % 5
        block[k] = ((h % (1 << 64)) >> 20) % half + (half if size < 1 << (cut + 1) else 0)
    sizes = Counter()
    for k, row in enumerate(rows):
        sizes[old[k], block[k]] += row[1]
    target = reshard.plan_transfers(dict(sizes), 5, 8).target
    order = sorted(range(len(rows)), key=lambda k: (target[old[k], block[k]], old[k], block[k], rows[k][0] is not None, rows[k][0] or 0, rows[k][2], rows[k][1]))
    slots, expected = Counter(), []
    for k in order:
        shard = target[old[k], block[k]]
        expected.append((str(rows[k][0]), rows[k][1], rows[k][2], shard, slots[shard]))
        slots[shard] += 1
    out = reshard.shard_digests(docs).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32, r.shard, r.slot) for r in out) == sorted(expected)
    moved = sum(rows[k][1] for k in range(len(rows)) if target[old[k], block[k]] != old[k])
    fair = sum(r[1] for r in rows) / 8
    held = [sum(rows[k][1] for k in range(len(rows)) if old[k] == s) for s in range(5)]
    least = sum(max(0, h - fair) for h in held)  # no flow can move less than what is over a fair share
    assert least - 8 <= moved <= least + 8 * max(sizes.values())  # and a block more at each border


def test_sizes_are_near_equal_and_files_stay(spark, tmp_path):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = reshard.reshard(docs, str(tmp_path), 5, 8)
    assert set(docs.columns) <= set(rows.columns) and rows.count() == docs.count()
    sizes = [r["sum(_size)"] for r in rows.groupBy("_shard").sum("_size").collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.01 * min(sizes)
    assert rows.where("_shard = _old_shard").count() > 0.4 * docs.count()


def test_written_tables_keep_their_schema(spark, no_docs):
    assert written(no_docs, "empty").schema.simpleString() == no_docs.schema.simpleString()
