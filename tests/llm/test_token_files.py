import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_packing import ODD, tokens  # noqa: F401
from small import documents  # noqa: F401

from gaugeline.llm.storage import open_output
from gaugeline.llm.token_files import EliasFano, TokenFile, token_offsets, write_token_files


@given(st.lists(st.integers(-(2**62), 2**62), max_size=700), st.booleans())
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values, small):
    values = sorted(v % 1000 if small else v for v in values)
    coded = EliasFano.from_bytes(EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert coded.decode().tolist() == values
    for k in range(0, len(values), 7):
        assert coded[k] == values[k]


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    bits = 8 * len(EliasFano.of(ends).to_bytes()) / len(ends)
    assert bits < 2.5 + np.log2(ends[-1] / len(ends))


def test_documents_come_back_in_order(documents, tokens):  # noqa: F811
    texts = dict(enumerate([*ODD, None, *ODD]))
    rows = {r.doc_id: r for r in token_offsets(documents(list(texts.items())[::-1])).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = np.array(tokens(texts[doc_id] or "") + [2], "<u4")
        row = rows[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_null_ids_repeated_rows_and_empty_tables(documents):  # noqa: F811
    assert token_offsets(documents([])).count() == 0
    rows = token_offsets(documents([(7, "a"), (None, "b"), (7, "a"), (-5, None)])).collect()
    assert sorted(r.start for r in rows) == [0, 2, 3, 5]
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [None, -5, 7, 7]


def test_a_document_is_fetched_by_its_place(documents, tokens):  # noqa: F811
    files = write_token_files(documents([(k, f"text number {k}") for k in range(50)])).orderBy("number").collect()
    file = TokenFile(files[-1].file)
    place = len(file) - 1
    assert file.doc_id(place) == 49
    assert file.ids(*file.bounds(place)).tolist() == tokens("text number 49") + [2]


def test_a_damaged_file_is_refused(documents, tmp_path):  # noqa: F811
    good = write_token_files(documents([(1, "a b c")])).first().file
    data = open(good.removeprefix("file://"), "rb").read()
    for bad in (data[:-1], b"x" + data[1:], data[:10] + data[12:]):
        name = str(tmp_path / "bad.ids")
        with open_output(name) as out:
            out.write(bad)
        with pytest.raises(ValueError):
            TokenFile(name)
