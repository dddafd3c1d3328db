"""What a worker of op11 remembers of earlier texts."""

import public_tokenizers

from lexiframe.llm import packing


class Asked(dict):
    def keys(self):
        raise AssertionError("walks over all that is remembered")


def test_remembered_runs_are_asked_one_by_one():
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        ids = packing.Ids(f.read())
    texts = [b"one two, three", b"two four", "hätte 中国 <x>".encode()]
    expected = [[x for r in t.decode().split() for x in ids.rules.encode(r, add_special_tokens=False).ids] for t in texts]
    ids.young, ids.old = Asked(), Asked()
    for _ in range(2):
        assert ids.of(texts) == [packing._bytes(x) for x in expected]
    ids.young, ids.old = Asked(), Asked(ids.young)
    assert ids.of(texts) == [packing._bytes(x) for x in expected]
