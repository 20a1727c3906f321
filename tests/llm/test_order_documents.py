"""Every document of the training order is named by the sequences that hold it."""

from tokenizers import Tokenizer

from titlematch.llm import training_order
from titlematch.llm.tokens import default_path


def test_every_document_is_listed(spark, tmp_path):
    library = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    texts = [(i, f"short text {i} " * (1 + i % 5 + 400 * (i == 30))) for i in range(60)] + [(None, "no id"), (60, None), (60, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    size = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts}
    rows = training_order.training_order(docs).collect()
    assert len({r.slot for r in rows}) == len(rows)
    covered = []
    for r in rows:
        assert (r.documents[0].doc_id, r.documents[0].start, r.documents[0].offset) == (r.doc_id, r.start, 0)
        ends = [d.offset for d in r.documents[1:]] + [r.length]
        covered += [(str(d.doc_id), d.start, d.start + end - d.offset) for d, end in zip(r.documents, ends, strict=True)]
    want = [str(i) for i, _ in texts]
    assert sorted(c[0] for c in covered if c[1] == 0) == sorted(want)
    for i, n in size.items():
        parts, at = sorted(c[1:] for c in covered if c[0] == str(i)), 0
        for start, end in parts if i != 60 else []:
            assert start == at
            at = end
        assert at == n or (i == 60 and parts == [(0, 1), (0, 1)])


def test_documents_from_a_slot_on(spark, tmp_path):
    path = str(tmp_path / "order")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string").repartition(2)
    n = training_order.materialise(docs, path, sequence=16, shard=20)
    every = {r.slot: r.documents for r in training_order.read_documents(spark, path).collect()}
    assert sorted(every) == list(range(n)) and {d.doc_id for own in every.values() for d in own} == set(range(500))
    rest = {r.slot: r.documents for r in training_order.read_documents(spark, path, 33).collect()}
    assert rest == {s: d for s, d in every.items() if s >= 33}
