import numpy as np

from tidemark.llm import repair, tokens
from tidemark.llm.queries import WORD_BPE

TEXTS = ["Plain words, plain WORDS. größe 日本!", "", "other words &&& it's Größe.", "ΑΣ", "q" * 150 + " plain"]


def test_new_stems_of_many_texts_take_one_library_call():
    own = tokens.WordIds(WORD_BPE)
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS]
    calls, library = [], own.pieces_only

    class Counted:
        def encode_batch_fast(self, inputs, **options):
            calls.append(sorted(inputs[0]))
            return library.encode_batch_fast(inputs, **options)

    own.pieces_only = Counted()
    assert [x.tolist() for x in own.each(TEXTS)] == want
    assert len(calls) == 1 and len(calls[0]) == len(set(calls[0])) == 6
    assert [x.tolist() for x in own.each(TEXTS)] == want
    assert calls[1:] == [["q" * 150]]  # too long to be remembered


def test_pieces_without_word_ends_are_encoded_one_by_one():
    own = tokens.WordIds(WORD_BPE)
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS]
    own.final[:] = False
    assert [x.tolist() for x in own.each(TEXTS)] == want


def test_keys_looked_up_together_stay_bounded():
    asked = []
    memory = tokens.Memory(lambda key: asked.append(key) or key, 10)
    for k in range(30):
        keys = ["used", *(f"x{i}" for i in range(3 * k, 3 * k + 3)), "y" * 101]
        assert memory.all(keys, lambda new: [key.upper() for key in new]) == [key.upper() for key in keys]
        assert len(memory) + len(memory.older) <= 10
    assert asked.count("used") == 1 and asked.count("y" * 101) == 30
    assert memory.all([], list) == []


def test_every_second_place_of_a_run():
    runs = [[1, 2, 3, 7, 9, 10], [4], [0, 1, 2, 3, 4, 6]]
    want = [[1, 3, 7, 9], [4], [0, 2, 4, 6]]
    for places, kept in zip(map(np.array, runs), want, strict=True):
        assert places[repair._every_second(np.diff(places) == 1)].tolist() == kept
    assert repair._every_second(np.zeros(0, bool)).tolist() == [0]


def test_documents_keep_their_ends_in_the_grammar():
    draw = np.random.default_rng(3)
    own = [np.tile(draw.integers(0, 3, 4), draw.integers(1, 40))[: draw.integers(1, 90)].astype("<u4") for _ in range(80)]
    own += [np.zeros(n, "<u4") for n in (1, 2, 3, 50, 1)]
    lengths = np.array([len(x) for x in own])
    sequence, ends, left, right = repair.grammar(np.concatenate(own), lengths, 5)
    assert len(left) > 5 and ends[-1] == len(sequence)

    def ids(symbol):
        return [symbol] if symbol < 5 else ids(left[symbol - 5]) + ids(right[symbol - 5])

    for text, a, b in zip(own, [0, *ends[:-1]], ends, strict=True):
        assert sum((ids(int(s)) for s in sequence[a:b]), []) == text.tolist()
