"""The pipeline's near-copy stage where ids repeat."""

import corpus_pipeline

ONE = " ".join(f"alpha{n}" for n in range(30))
OTHER = " ".join(f"beta{n}" for n in range(30))


def test_repeated_ids_keep_one_row_of_each_component(spark, documents):
    rows = [(1, ONE), (2, ONE + " end"), (2, OTHER), (3, OTHER + " end"), (3, "clean text of its own"), (1, ONE), (1, ONE + " more")]
    rows += [(None, ONE), (None, "a text without id"), (4, ""), (4, ""), (None, None)]
    docs = documents(rows)
    found = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    kept = sorted(repr((row.doc_id, row.text)) for row in found)
    firsts = [text for doc, text in ((row.doc_id, row.text) for row in found) if doc == 1]
    assert len(firsts) == 1 and firsts[0] in (ONE, ONE + " more")
    want = [(1, firsts[0]), (2, OTHER), (3, "clean text of its own"), (None, "a text without id"), (4, ""), (4, ""), (None, None)]
    assert kept == sorted(map(repr, want))
