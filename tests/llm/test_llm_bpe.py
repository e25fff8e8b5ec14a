import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from opinara.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts_as_the_library(library):
    table = bpe.Vocabulary(PATH)
    pick = random.Random(1)
    pool = [*"abcdeΣσςİıßéÉñ'’ \t\n\x1c\x85\xa0　̣́한글日本🙂‍0123٣½_-<|>", "<|endoftext|>", "<|startoftext|>", "'s", "'RE", "the"]
    for _ in range(4000):
        text = "".join(pick.choices(pool, k=pick.randint(0, 25)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert table.encode(text).tolist() == ids, repr(text)
        assert table.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_a_full_word_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    monkeypatch.setattr(bpe, "CACHED_PIECES", 2)
    table = bpe.Vocabulary(PATH)
    text = "these are more words than three and these are more words again " * 3
    assert table.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_rows(spark, library):
    texts = [None, "", " \n", "One  two", "x" * 30_000, "long text, " * 20_000, "a<|endoftext|>b"]
    rows = [(i, t, "other", 0) for i, t in enumerate(texts)] + [(3, "One  two", "again", 1), (None, "no id", "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    found = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(found) == len(rows)
    want = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids for r in rows}
    for row in found:
        assert row["ids"] == want[row["doc_id"]]
        assert row["decoded"] == library.decode(row["ids"], skip_special_tokens=False)
    once = bpe.encode(docs, PATH, decoded=True)
    assert sorted(map(str, once.collect())) == sorted(map(str, found))
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).collect() == []
