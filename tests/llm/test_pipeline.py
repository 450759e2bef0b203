"""The queries against their SQL, and the pipeline stage by stage against plain versions."""

from collections import Counter

import plain
import pytest
from check_queries import compare, connect
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from pagelode.llm.common import tokenizer_path
from pagelode.llm.oracle import oracle_sql
from pagelode.session import materialise


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, small, name):
    assert compare(spark, connect(small), small, name, oracle_sql()[name]).startswith("ok")


def test_all_are_registered():
    names = [n for n in contract.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    quality, near, private, mixture, tokens = (f for _, f in corpus_pipeline.STAGES)
    before = {r.doc_id: r.text for r in docs.collect()}

    kept = materialise(quality(spark, docs, small), "t")
    good = {d for d, t in before.items() if (m := plain.measures(t))[0] >= 50 and 100 * m[4] <= 50 * m[0]}
    assert {r.doc_id for r in kept.collect()} == good  # no host of this table is rejected

    single = materialise(near(spark, kept, small), "t")
    first = {c if n else d for d, n, c in plain.near_copies([(d, before[d]) for d in sorted(good)])}
    assert Counter(r.doc_id for r in single.collect()) == Counter(first)

    clean = materialise(private(spark, single, small), "t")
    assert {r.doc_id: r.text for r in clean.collect()} == {d: plain.redacted(before[d]) for d in first}

    mixed = materialise(mixture(spark, clean, small), "t")
    assert mixed.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert all(texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) for r in mixed.collect())
    share = lambda rows: sum(len(plain.words(r.text)) for r in rows)
    assert abs(share(mixed.collect()) - share(clean.collect())) <= 20

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tokens(spark, mixed, small).collect())
    assert got == Counter((r.doc_id, *plain.encoded(tokenizer, r.text)) for r in mixed.collect())
