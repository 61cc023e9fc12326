"""Every stage takes effect, and the stages' rows are those of the operators one by one."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from shelfmark.llm import queries


def test_run_matches_the_operators(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in queries.documents(spark, folder).collect()}
    toxic = {r["doc_id"] for r in queries.op6_toxicity(spark, folder).filter("predicted = 1").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontamination", "secrets", "bpe"]
    from test_near_copies import classes

    clean = [(i, t) for i, t in sorted(docs.items()) if i not in toxic]
    single = {i for i, (n, low) in classes(clean).items() if n == 0 or low == i}
    leaks = {r["doc_id"] for r in queries.op10_decontamination(spark, folder).collect()}
    secret = {r["doc_id"] for r in queries.op5_secret_scan(spark, folder).filter("spans <> ''").collect()}
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(rows) == single - leaks and leaks
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for key, row in rows.items():
        same = row["ids"] == library.encode(docs[key], add_special_tokens=False).ids
        assert same != (key in secret)
