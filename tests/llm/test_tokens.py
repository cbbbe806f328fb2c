import pytest

from staylens.llm import tokens


@pytest.mark.parametrize("group", [1, 40, 1 << 22])
def test_ids_of_grouped_texts_equal_the_library(monkeypatch, group):
    monkeypatch.setattr(tokens, "GROUP_BYTES", group, raising=False)
    tokenizer = tokens.ChunkTokenizer(tokens.word_vocabulary())
    texts = ["", "One two, TWO\nthree  ", "", "x" * 200 + " naïve Ärger 漢字 a.b!", "two " * 30, "\n", "one-off 12,5"]
    want = [tokenizer.tokenizer.encode(t.lower(), add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        got = list(tokenizer.ids([t.encode() for t in texts]))
        assert [[int.from_bytes(g[i : i + 4], "little") for i in range(0, len(g), 4)] for g in got] == want
    assert list(tokenizer.ids([])) == []


def test_a_word_is_looked_up_once_per_group():
    class Counted(dict):
        looks = 0

        def get(self, *a):
            Counted.looks += 1
            return super().get(*a)

        def __getitem__(self, k):
            Counted.looks += 1
            return super().__getitem__(k)

    tokenizer = tokens.ChunkTokenizer(tokens.word_vocabulary())
    list(tokenizer.ids([b"a few words"]))
    tokenizer.known = Counted(tokenizer.known)
    assert len(b"".join(tokenizer.ids([b"a few words " * 1000] * 50))) == 4 * 150_000
    assert Counted.looks < 100
