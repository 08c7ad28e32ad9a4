"""The ten operators on small fixtures with nulls, empty and long texts, ties, repeats and odd columns."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrocal.llm import mixing, packing, pq_dedup, pu_quality, quality_rules, registry, sharding, substring_dedup, token_rans, url_cascade
from hydrocal.llm.components import components
from hydrocal.llm.minhash_dedup import near_duplicates, without_near_duplicates
from hydrocal.llm.superminhash import signatures
from hydrocal.llm.tokens import default_tokenizer_path, encoder
from tests.llm import brute
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, slot string"


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    base, passage = prose(120), prose(50)
    near = base.split()
    near[7] = "changed"
    chain = near.copy()
    chain[60] = "other"
    out = [
        (1, base), (2, base.upper().lower()), (3, " ".join(near)), (4, " ".join(chain)), (5, prose(90) + " " + passage), (6, passage + "\n" + prose(40)),
        (7, None), (8, ""), (9, " \t\n "), (10, "a b"), (11, "A\tB"), (12, "one"), (13, "x " * 200), (13, "x " * 200), (14, prose(30_000)),
        (None, prose(60)), (None, base), (15, "é中 ́!" * 50), (16, "<|endoftext|> a\u00a0 b"), (-3, passage), (17, "\x1c\x85 y z w v"),
    ]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{n % 3}" if n % 5 else None, None if t is None else len(t), n, "x") for n, (i, t) in enumerate(texts())]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_encoder_equals_the_library():
    e, rng = encoder(default_tokenizer_path()), random.Random(1)
    parts = ["a", "B", "é", " ", "\n", "\t", ".", ",", "'s", "1", "\u00a0", "中", "  ", "\r\n", "!", "<|endoftext|>", "\u0301", "_", "\0", "\u2003"]
    tried = ["".join(rng.choices(parts, k=rng.randint(0, 10))) for _ in range(3000)]
    assert [x.tolist() for x in e.encode(tried)] == [e.tok.encode(x, add_special_tokens=False).ids for x in tried]


def test_encoder_forgets_without_error(monkeypatch):
    from hydrocal.llm.tokens import Encoder

    e = Encoder(default_tokenizer_path())
    monkeypatch.setattr(Encoder, "LIMIT", 50)
    tried = [" ".join(f"word{i % 90}x{j}" for i in range(j, j + 20)) for j in range(60)]
    got = [x.tolist() for j in range(0, 60, 5) for x in e.encode(tried[j : j + 5])]
    assert got == [e.tok.encode(x, add_special_tokens=False).ids for x in tried]


def test_ids_round_trip(spark, docs, none, tmp_path):
    token_rans.write_ids(docs, f"{tmp_path}/a")
    got = token_rans.read_ids(spark, f"{tmp_path}/a").collect()
    e = encoder(default_tokenizer_path())
    expected, start = [], 0
    for i, t in sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = e.tok.encode(t or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), ids))
        start += len(ids)
    assert ordered(got) == ordered(expected)
    token_rans.write_ids(none, f"{tmp_path}/b")
    assert token_rans.read_ids(spark, f"{tmp_path}/b").count() == 0


def test_damaged_block_is_noticed():
    ids = np.random.default_rng(1).integers(0, 500, 200_000)
    tokens, freq, bits = token_rans.scaled(dict(enumerate(np.bincount(ids).tolist())))
    row = token_rans.encode_blocks([ids], tokens, freq, bits)[0] | {"n_tokens": len(ids), "part": 0, "block": 0}
    assert (token_rans.decode_blocks([row], tokens, freq, bits)[0] == ids).all()
    words = bytearray(row["words"])
    words[len(words) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        token_rans.decode_blocks([row | {"words": bytes(words)}], tokens, freq, bits)


def test_signatures_estimate_similarity():
    rng, found = np.random.default_rng(2), []
    for _ in range(40):
        u = rng.integers(0, 1 << 63, 1000, np.uint64)
        s = signatures(np.concatenate([u[:800], u[200:]]), np.repeat([0, 1], 800), 2, 128)
        found.append((s[0] == s[1]).mean())
    assert abs(np.mean(found) - 0.6) < 0.03


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(200)] + [(5, 5), (1000, 1001), (1001, 1000), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(i, 0) for i in range(201)] + [(1000, 1000), (1001, 1000)]


def test_near_duplicates(spark, docs, none):
    got = near_duplicates(docs, shingle=4).collect()
    assert ordered(got) == ordered(brute.near_duplicates(texts(), 4))
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(13) == 1 and 1 in ids and 4 not in ids and {7, 8, 9} <= set(ids)
    assert near_duplicates(none).count() == 0 and without_near_duplicates(none).count() == 0


def test_near_duplicates_that_a_bucket_star_misses(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(150):  # copies about 0.6 to 0.8 apart from each other, all in shared buckets
        w = base.copy()
        for _ in range(rng.randint(8, 20)):
            w[rng.randrange(300)] = f"e{i}.{rng.random()}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, t.replace("b150", "zz")) for i, t in rows[::7]]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    assert ordered(got) == ordered(brute.near_duplicates(rows, 4))


def test_sharding(spark, docs, none):
    t = sharding.lookup_table([f"n{i}" for i in range(7)], 1009)
    sizes = np.bincount(t)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.lookup_table([f"n{i}" for i in range(6)], 1009)
    assert sum(a != b for a, b in zip(t, fewer) if a < 6) < 1009 * 0.25  # most slots of the others stay
    got = sharding.shard(docs.drop("slot"), "doc_id")
    assert got.count() == docs.count() and got.where("shard is null").count() == 0
    assert got.where("doc_id = 13").select("shard").distinct().count() == 1
    spread = sharding.shard(docs.drop("slot").withColumnRenamed("row", "r"), "lang", salt="r", spread=16)
    assert spread.select("shard").distinct().count() > 3
    assert sharding.shard(none.drop("slot"), "doc_id").count() == 0
    with pytest.raises(ValueError):
        sharding.shard(docs, "doc_id")
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 1000)


def test_mixing(spark, docs, none):
    rows = mixing.mixture(docs).collect()
    assert len(rows) == len(texts()) and all(r.taken <= 2 * r["size"] for r in rows)
    assert ordered(rows) == ordered(mixing.mixture(docs.repartition(5)).collect())
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r["size"] for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own)
    total = sum(r["size"] for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - 1.5 * total) < 1e-6 * total
    assert mixing.mixture(none).count() == 0
    empty = docs.withColumn("text", docs["lang"].substr(9, 1))
    assert {r.taken for r in mixing.mixture(empty).collect()} == {0}


def test_substring_dedup(spark, docs, none):
    import hashlib

    for window, first in ((35, 18), (35, 9), (5, 5), (8, 3)):
        got = substring_dedup.substring_dedup(docs, window, first, digest=lambda kept: hashlib.sha256(kept).hexdigest()).collect()
        assert ordered(got) == ordered(brute.without_repeats(texts(), window)), (window, first)
    assert substring_dedup.substring_dedup(none).count() == 0


def test_packing(spark, docs, none):
    got = packing.packed(docs, capacity=256).toPandas()
    e = encoder(default_tokenizer_path())
    for (i, piece), own in got.groupby(["doc_id", "piece"]):
        if i == 14:
            ids = e.tok.encode(texts()[14][1], add_special_tokens=False).ids + [0]
            start, length, crc = (int(own[c].iloc[0]) for c in ("start", "length", "ids_crc32"))
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            assert length == 256 or piece == 0
    got = got.sort_values(["sequence_id", "offset"])
    filled = got.groupby("sequence_id").length
    assert (filled.cumsum() - got.length == got.offset).all() and filled.sum().max() <= 256
    assert len(filled.sum()) <= 1.05 * np.ceil(got.length.sum() / 256) + 1
    assert packing.packed(none).count() == 0


def test_packing_over_many_groups(spark):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 2049, 3000)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "item long, length long")
    got = packing.pack(items, group=200).toPandas().assign(length=lambda d: lengths[d["item"]]).sort_values(["sequence_id", "offset"])
    filled = got.groupby("sequence_id").length
    assert len(got) == 3000 and got["item"].is_unique and filled.sum().max() <= 2048
    assert (filled.cumsum() - got.length == got.offset).all()
    assert filled.ngroups <= 1.06 * lengths.sum() / 2048


def test_quality_rules_match_sql(spark, docs, none, monkeypatch):
    import pyarrow as pa

    con = duckdb.connect()
    con.register("documents", pa.Table.from_pandas(docs.toPandas().astype({"doc_id": "Int64"}), preserve_index=False))
    sql = quality_rules.ORACLE_SQL.replace("> 100)", "> 1)")
    rows = quality_rules.quality_rules(docs, max_docs=1)
    expected = con.execute(sql)
    cols = [c[0] for c in expected.description]
    assert digest(rows.columns, [tuple(r) for r in rows.collect()]) == digest(cols, expected.fetchall())
    assert quality_rules.quality_rules(none).count() == 0


def test_quality_rules_compare_whole_hashes_in_long_texts(spark):
    # The hashes of "q9286622 a b" and "q7116841 a b" differ in their low 18 bits only; the text has one true repeat, of 6 words.
    text = "q9286622 a b x q7116841 a b r s t y r s t " + " ".join(f"w{i}" for i in range(140_000))
    df = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    assert quality_rules.base_counts(df).first().n_repeat_words == 6


def test_pu_quality(spark, docs, none):
    p, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = pu_quality.scored(p, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) >= 50 and np.mean([r.predicted == r.quality for r in held]) >= 0.95
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) quality")
    again = {r.doc_id: r.score for r in pu_quality.scored(p, flipped).collect()}
    assert all(again[r.doc_id] == r.score for r in got)  # held-out labels play no part
    odd = pu_quality.scored(docs, labels.limit(0)).collect()
    assert len(odd) == len(texts()) and all(r.score == 0.5 for r in odd)
    assert pu_quality.scored(none, labels).count() == 0


def test_url_cascade_is_exact(spark):
    rng = random.Random(9)
    hosts = [f"h{i}.{rng.choice('abc')}.net" for i in range(3000)]
    urls = [f"http://{h.upper()}/p?x" for h in hosts] + [None, "", "no host", "https://", "ftp://x", "a://b://c", "http://sub.example.org/es/1", "http://example.org", "http://org/", "http://x.com/de/\n/y"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "y")], "page_id long, url string, host string")
    for share in (0, 0.02, 0.5, 1):
        listed = {h for h in hosts if rng.random() < share}
        got = url_cascade.judge(pages, spark.createDataFrame([(h,) for h in sorted(listed)] + [(None,), ("elsewhere.org",)], "host string")).collect()
        assert len(got) == len(urls) + 1
        assert all(r.listed == (r.host in listed) for r in got)
    by = {r.page_id: r for r in got}
    n = len(hosts)
    assert [by[n + k].host for k in range(6)] == ["", "", "", "", "x", "b:"] and by[n + 6].rule == "example.org/es/" and by[n + 6].verdict == "block"
    assert by[n + 7].rule is None and by[n + 8].rule == "org/" and by[n + 9].rule == "com/de/"
    assert url_cascade.judge(pages.limit(0), pages.select("host").limit(0)).count() == 0


def test_pq_dedup(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 16)).astype(np.float32)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 8] + rng.normal(size=16).astype(np.float32) * 0.15).tolist(), (i % 8) % 3) for i in range(60)]
    rows += [(200 + i, base[0].tolist(), 0) for i in range(20)] + [(300, None, 0), (301, [0.0] * 16, 0), (302, [None] + [1.0] * 15, 0), (303, [float("nan")] * 16, 0)]
    rows += [(304, base[0].tolist(), None), (305, [1.0, 2.0], 0), (306, [2.0, 4.0], 0), (307, [], 0), (None, base[0].tolist(), 0), (0, base[0].tolist(), 0), (308, (base[1] * 1e30).tolist(), 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, row string")
    got = pq_dedup.linked_vectors(df).collect()
    expected = brute.linked_vectors(rows, 0.93)
    assert sum(r.n_links for r in got) >= 0.9 * sum(r[1] for r in expected)
    assert ordered(got) == ordered(expected)
    assert pq_dedup.linked_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [200, 4096])
def test_pq_dedup_finds_links_across_far_lists(spark, monkeypatch, block):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(6, 32))
    v = np.concatenate([rng.normal(size=(500, 32)), base[rng.integers(0, 6, 2500)] + rng.normal(size=(2500, 32)) * 0.27]).astype(np.float32)
    label = np.arange(len(v)) % 2
    x = v.astype(float)
    links = (x @ x.T / np.sqrt(np.outer((x * x).sum(axis=1), (x * x).sum(axis=1))) >= 0.93) & (label[:, None] == label)
    ids = list(range(len(v)))
    expected = list(zip(ids, (links.sum(axis=1) - 1).tolist(), brute.components_of(ids, np.argwhere(np.triu(links, 1)).tolist())))
    df = spark.createDataFrame([(i, v[i].tolist(), int(label[i])) for i in ids], "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(pq_dedup, "BLOCK", block)
    assert ordered(r[:3] for r in pq_dedup.linked_vectors(df).collect()) == expected


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    res = con.execute(registry.ORACLE_SQL[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest([c[0] for c in res.description], res.fetchall())


def test_queries_match_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert ordered(registry.QUERIES["op2_superminhash_dedup"](spark, SF).collect()) == ordered(brute.near_duplicates(rows, 4))
    assert ordered(registry.QUERIES["op5_substring_dedup"](spark, SF).collect()) == ordered(brute.without_repeats(rows, 35))
    vecs = duckdb.sql(f"select vec_id, embedding, label from '{SF}/embeddings.parquet'").fetchall()
    assert ordered(registry.QUERIES["op10_pq_dedup"](spark, SF).collect()) == ordered(brute.linked_vectors(vecs, 0.93))


def test_token_files_are_in_order_and_describe_themselves(spark, tmp_path):
    """Read file by file in order of names, blocks hold ascending ids; lanes and checkpoints are read from them."""
    import pyarrow.parquet as pq

    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7)
    token_rans.write_ids(docs.unionByName(docs.withColumn("doc_id", docs.doc_id + 100_000)), f"{tmp_path}/a")
    seen = [i for f in sorted((tmp_path / "a" / "blocks").glob("*.parquet")) for r in pq.read_table(f).to_pylist() for i in r["doc_ids"]]
    assert seen == sorted(seen) and len(set(seen)) == len(seen) == 400
    ids = np.random.default_rng(1).integers(0, 500, 100_000)
    table = token_rans.scaled(dict(enumerate(np.bincount(ids).tolist())))
    rows = [token_rans.encode_blocks([ids], *table, lanes=n, check_steps=k)[0] | {"n_tokens": len(ids), "part": 0, "block": 0} for n, k in ((64, 100), (128, 512), (7, 3000))]
    for got in token_rans.decode_blocks(rows, *table):
        assert (got == ids).all()


def test_op1_against_the_library(spark):
    e, start, expected = encoder(default_tokenizer_path()), 0, []
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = [*e.tok.encode(r.text or "", add_special_tokens=False).ids, 2]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert ordered(token_rans.op1_token_rans(spark, SF).collect()) == expected


def test_samples_for_training_pass_few_rows_on(spark):
    from hydrocal.llm.common import hashed_sample

    df = spark.range(50_000).repartition(20)
    want = sorted(r.id for r in df.orderBy(F.xxhash64("id"), "id").limit(500).collect())
    got = hashed_sample(df, "id", 500)
    assert sorted(r.id for r in got.collect()) == want
    assert "xxhash64(id" in got._jdf.queryExecution().optimizedPlan().toString().split("Filter")[1].split("\n")[0]
    assert hashed_sample(df, "id", 80_000).count() == 50_000
    one = spark.range(10_000).select(F.lit(7).alias("id"))
    assert hashed_sample(one, "id", 300).count() == 300


def test_lines_over_the_limit_deplete_documents(spark):
    """The rule rejects documents of a real table once its limit is below what the table holds; with the
    columns in the order of the contract."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = quality_rules.quality_rules(docs, max_docs=1).collect()
    depleted = [r for r in rows if not r.base_failed and not r.kept]
    assert depleted and all(r.n_kept_words < max(quality_rules.MIN_WORDS, quality_rules.MIN_SHARE * r.n_words) for r in depleted)
    assert list(rows[0].asDict())[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_sets_are_compared_on_whole_hashes():
    from hydrocal.llm.minhash_dedup import from_bytes, set_bytes

    s = np.unique(np.random.default_rng(5).integers(0, 1 << 63, 100_000, np.uint64))
    near = s ^ np.uint64(1 << 45)  # differ above the low 40 bits alone
    assert (from_bytes(set_bytes(s)).view(np.uint64) == s).all()
    assert not np.isin(from_bytes(set_bytes(near)), from_bytes(set_bytes(s))).any()
