import numpy as np
import pytest
from tokenizers import Tokenizer

from pulsevault.llm import token_counts as T
from pulsevault.llm.tokens import tokenizer_path

from .helpers import ODD, documents, text

TOKENIZER = Tokenizer.from_file(tokenizer_path())


@pytest.mark.parametrize("block", [1 << 10, 7, 1 << 20])
def test_counts_equal_the_tokenizer(spark, tmp_path, block):
    rows = [*ODD, (None, "nor here"), *[(10 + i, text(i, 3 * i)) for i in range(15)]]
    if block < 100:
        rows = [r for r in rows if len(r[1] or "") < 1000]
    documents(spark, rows, extra=True).repartition(3).write.parquet(str(tmp_path / "docs"))
    got = T.token_counts(spark.read.parquet(str(tmp_path / "docs")), block_tokens=block, docs_per_file=4).collect()
    want = sorted((str(i), len(TOKENIZER.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == want and all(r.closed for r in got)
    assert len({r.file for r in got}) > 3
    for file in {r.file for r in got}:
        at = 0
        for r in sorted((r for r in got if r.file == file), key=lambda r: r.doc_no):
            assert r.start == at
            at += r.n_tokens + 1


def test_the_separators_string_in_a_text_separates_nothing(spark, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "x")]
    documents(spark, rows).coalesce(1).write.parquet(str(tmp_path / "docs"))
    got = {r.doc_id: r.n_tokens for r in T.token_counts(spark.read.parquet(str(tmp_path / "docs"))).collect()}
    assert set(got) == {1, 2, 3} and got[2] > 1 and got[1] >= got[2] + 2 and got[3] == 1


def test_ids_that_do_not_fit_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="equal to 87"):
        T.write_flat(documents(spark, [(1, "x")]), str(tmp_path / "flat"), end_id=87)


def test_empty(spark):
    assert T.token_counts(documents(spark, [])).count() == 0


def test_open_end_and_foreign_files(spark, tmp_path):
    ids = np.array([T.END, 5, 6, T.END, T.END, 7, 8, 9], "<u2")  # an odd alignment of the separator's bytes is no separator
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    (tmp_path / "b.bin").write_bytes(np.array([0x50C4, 0xC450, 0x5050], "<u2").tobytes())
    for block in (1, 2, 3, 100):
        got = T.document_tokens(T.scan_blocks(spark, str(tmp_path), block_tokens=block)).orderBy("file", "doc_no").collect()
        assert [(r.doc_no, r.start, r.n_tokens, r.closed) for r in got] == [(0, 0, 0, True), (1, 1, 2, True), (2, 4, 0, True), (3, 5, 3, False), (0, 0, 1, True), (1, 2, 1, False)]
