from pyspark.sql import functions as F
from support import SF, as_rows

import __spark_entry__ as entry
import corpus_pipeline
from strataflow.llm import queries


def test_queries_equal_their_sql(spark, duck):
    for name, sql in queries.ORACLE_SQL.items():
        df = entry.queries()[name](spark, SF)
        cursor = duck.execute(sql)
        names = [c[0] for c in cursor.description]
        assert as_rows(df.columns, df.collect()) == as_rows(names, cursor.fetchall()), name


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert entry.queries().keys() >= {"pipeline", *queries.QUERIES}


def test_stages_keep_columns_and_only_drop(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns and out.join(docs, "doc_id", "left_anti").count() == 0
            assert 0 < out.count() <= docs.count()
        docs = out
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"} <= set(docs.columns)
    assert corpus_pipeline.run(spark, SF).count() == docs.count()


def test_texts_that_share_an_id_are_told_apart(spark):
    from llm_support import prose

    near = prose(21, 200)
    rows = [(1, near), (2, prose(22, 200)), (2, near + " end"), (2, prose(23, 200)), (2, prose(23, 200)), (3, prose(24, 200)), (3, prose(25, 200)), (4, prose(23, 200) + " end"), (None, near)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string").repartition(3)
    out = corpus_pipeline.one_of_each_class(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in out.collect())
    assert got == sorted([("1", near), ("2", prose(22, 200)), ("2", prose(23, 200)), ("3", prose(24, 200)), ("3", prose(25, 200)), ("None", near)])


def test_one_of_each_class_equals_brute_force_whatever_the_order(spark):
    import random

    from llm_support import prose
    from test_tables import brute_links

    texts = [prose(40, 120), prose(40, 120) + " end", prose(41, 90), None, "", "!!", "one two", prose(42, 60)]
    draw = random.Random(4)
    rows = [(draw.choice([None, *range(12)]), draw.choice(texts)) for _ in range(70)] + [(5, "B"), (3, "B"), (5, "A")]
    for seed in (1, 2):
        draw.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(seed + 1)
        got = sorted((str(r.doc_id), r.text or "") for r in corpus_pipeline.one_of_each_class(spark, docs, SF).collect())
        # Every text as a document of its own, joined pair by pair; of each class the least id, then the least digest.
        import hashlib

        digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
        named = sorted({(k, t or "") for k, t in rows if k is not None})
        alone = {t: n for n, t in enumerate(sorted({t for _, t in named}))}
        linked = dict((int(k), int(c)) for k, c, _ in brute_links([(n, t) for t, n in alone.items()]))
        best = {}
        for k, t in named:
            best[linked[alone[t]]] = min(best.get(linked[alone[t]], (1 << 60, "", "")), (k, digest(t), t))
        expected = [(str(k), t) for k, _, t in best.values()] + [("None", t or "") for k, t in rows if k is None]
        assert got == sorted(expected)


def test_stages_leave_clashing_columns_as_they_were(spark, odd_docs):
    docs = odd_docs.withColumn("_text_digest", F.lit("own"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert {(r.n_words, r.score, r.ids, bytes(r.hit_words), r.kept, r._text_digest) for r in out.collect()} <= {(5, -1, "mine", b"mine", True, "own")}


def test_stages_take_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs.drop("ids", "score", "n_words", "hit_words", "kept"), odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= docs.count()
