"""Words, shingles and token ids against plain Python."""

import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lapwise.llm.queries import tokenizer_path
from lapwise.llm.texts import ALPHANUMERIC, NOT_SPACE, hash_text, shingle_hashes, slices, texts_of, words_of
from lapwise.llm.tokens import Encoder

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB ,.'\n\té1 \x0b-", max_size=30)), max_size=6)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@given(TEXTS)
@settings(deadline=None)
def test_words(rows):
    texts = texts_of(pa.array(rows, pa.string()))
    for table, pattern in ((NOT_SPACE, r"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = words_of(texts, table)
        expected = [re.findall(pattern, lower(t)) for t in rows]
        assert words.counts.tolist() == [len(w) for w in expected]
        assert words.hash.tolist() == [hash_text(w) for row in expected for w in row]


@given(TEXTS, st.integers(1, 4))
@settings(deadline=None)
def test_shingles(rows, width):
    found, bounds = shingle_hashes(words_of(texts_of(pa.array(rows, pa.string())), NOT_SPACE), width)
    meaning = {}
    for row, a, b in zip(rows, bounds[:-1], bounds[1:], strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(row))
        expected = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] or ([tuple(words)] if words else [])
        assert b - a == len(expected)
        for value, shingle in zip(found[a:b], expected, strict=True):
            assert meaning.setdefault(int(value), shingle) == shingle
    assert len(set(meaning.values())) == len(meaning)


def test_slices_cover_all_rows():
    rows = ["a" * n for n in (5, 0, 50, 3, 3, 3)] + [None]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(rows), "id": list(range(7))}).slice(1)
    parts = list(slices([batch], "text", 7))
    assert [i for b, _ in parts for i in b.column(1).to_pylist()] == [1, 2, 3, 4, 5, 6]
    assert [t.raw(i).decode() for _, t in parts for i in range(len(t))] == [r or "" for r in rows[1:]]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(tokenizer_path())


@given(st.lists(st.text(alphabet="ab A'sé \n\t!,1 　<|>", max_size=25), max_size=4))
@settings(deadline=None)
def test_token_ids_are_those_of_whole_texts(encoder, rows):
    rows = [*rows, "it's <|endoftext|> ok", "", "x  y \n\n z!"]
    ids, bounds = encoder.encode(texts_of(pa.array(rows, pa.string())))
    for row, a, b in zip(rows, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == encoder.tokenizer.encode(row, add_special_tokens=False).ids


def test_words_are_forgotten_and_learned_again(encoder, monkeypatch):
    monkeypatch.setattr("lapwise.llm.tokens.REMEMBERED_BYTES", 100)
    for text in ("one two three four five", "six seven eight nine", "one two"):
        ids, _ = encoder.encode(texts_of(pa.array([text])))
        assert ids.tolist() == encoder.whole(text).tolist()


