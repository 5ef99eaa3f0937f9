import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "",
    " ",
    "it's we'll I'd 's",
    "a  b\n\n c\t\td \n",
    "x<|endoftext|> y <|endoftext|>",
    "  <|endoftext|>  z",
    "<|endo" + "ftext|>",
    "é à ñandú ЖЖЖ 日本語テスト 🙂🙂",
    "tail   ",
    "1234567 12.5% --- ***!!!???",
    "a\x1cb\x85c　d e",
    "ab" * 5000,
    "the" * 3000 + " end",
    "!" * 4000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(PATH)


def random_texts(n):
    draw = random.Random(7)
    parts = ["the", "ing", "idiot", " ", "  ", "\n", "'", "l", "s", "'ll", "é", "ß", "9", "42", "!", "...", "🙂", "　"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 80))) for _ in range(n)]


def test_chunks_as_the_library(library, own):
    for text in ODD + random_texts(300):
        ids = bpe.unpacked(own.encoded(text))
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:50]
        assert own.decoded(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [1, 3, 10, 64])
def test_tree_as_the_library(library, own, leaf, monkeypatch):
    monkeypatch.setattr(bpe, "UNIT", 8)
    for text in [x[:600] for x in ODD] + random_texts(150):
        ids = b""
        for k, segment in enumerate(own.segments(text)):
            if k % 2:
                ids += bpe.packed([own.special[segment]])
            else:
                ids += b"".join(own.tree([own.leaf(p) for p in bpe.halved(segment, leaf)]).ids)
        assert bpe.unpacked(ids) == library.encode(text, add_special_tokens=False).ids, text[:50]


def test_documents(spark, library):
    texts = [*ODD, None, "same words", "same words"]
    rows = [(i if i else None, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = sorted(bpe.token_digests(docs, PATH, leaf=100).collect(), key=lambda r: r.doc_id or 0)
    assert len(got) == len(texts)
    for text, row in zip(texts, got, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.token_digests(docs.limit(0), PATH).count() == 0


def test_runs_of_punctuation_take_no_library_call(monkeypatch):
    from tidemark.llm import tokens
    from tidemark.llm.queries import WORD_BPE

    own = tokens.WordIds(WORD_BPE)
    library = own.tokenizer
    words = ["ab&&&", "Ab$$$", "ÉÖ***", "x!?", "a.,%%%", "日本!!", "ab###", "q" * 30 + "&" * 200]
    odd = ["&&&", "a'&", "ab&c&", "<|endoftext|>!!", "a<|endoftext|>&", "é!!", "ΑΣ!!", "it's!!", "1!!", "a!́", "İ&&"]
    want = {w: library.encode(w, add_special_tokens=False).ids for w in words + odd}
    assert {w: list(memoryview(own.encode(w)).cast("I")) for w in words + odd} == want

    class Refused:
        def encode(self, *_, **__):
            raise AssertionError("called")

    fresh = tokens.WordIds(WORD_BPE)
    fresh.tokenizer = Refused()
    assert {w: list(memoryview(fresh.encode(w)).cast("I")) for w in words} == {w: want[w] for w in words}


MIXED = [
    "", " ", "Plain Words, plain words!? plain", "  two\n\nlines\t\x0b\x0c end. ", "a\x1cb a\x1fb", "x\x85y\xa0z q r　s​t",
    "ΑΣ ΑΣ. Straße, ÉÖ É É! T̈ T̈. İx İ, K ǅ", "日本語。 日本!!", "<|endoftext|> a<|endoftext|>&", "<|ENDOFTEXT|> <|EndOfText|>.", "IT'S it's!! 1,234.5% (a) a-b &&& !",
    "q" * 300 + "&" * 300 + " Q" + "q" * 299, " ".join(f"w{i} W{i % 7}, word{'abc'[i % 3]}" for i in range(500)),
]


@pytest.mark.parametrize("together", [1, 40, 1 << 20])
def test_words_of_many_texts_together(together, monkeypatch):
    from tidemark.llm import tokens
    from tidemark.llm.queries import WORD_BPE

    monkeypatch.setattr(tokens, "TOGETHER", together)
    own = tokens.WordIds(WORD_BPE)
    texts = MIXED + random_texts(200) + MIXED[::-1]
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in own.each(texts)] == want
    assert [x.tolist() for x in own.each(texts, 1)] == [[*x, 1] for x in want]
    assert list(own.each([])) == [] and [own.encode(t) for t in texts[:12]] == [x.tobytes() for x in own.each(texts[:12])]


def test_a_stem_is_encoded_once_for_all_its_spellings():
    from tidemark.llm import tokens
    from tidemark.llm.queries import WORD_BPE

    own = tokens.WordIds(WORD_BPE)
    calls = []
    own.stems.find = lambda stem, find=own.stem: calls.append(stem) or find(stem)
    list(own.each(["Word word. WORD, word!? other", "wOrd, Other", "größe. GRÖSSE Größe!"]))
    assert sorted(calls) == ["grösse", "größe", "other", "word"]


def test_memory_stays_bounded_and_keeps_what_is_used():
    from tidemark.llm.tokens import Memory

    calls = []
    memory = Memory(lambda key: calls.append(key) or key.upper(), 10)
    for k in range(100):
        assert memory["used"] == "USED" and memory[f"x{k}"] == f"X{k}"
        assert len(memory) + len(memory.older) <= 10
    assert calls.count("used") == 1 and len(calls) == 101
    none = Memory(lambda key: calls.append(key), 10)
    assert none["none"] is None and none["none"] is None and calls.count("none") == 1


def test_workers_give_up_what_other_operators_keep():
    import gc
    import weakref

    from tidemark.llm import common, tokens
    from tidemark.llm.queries import WORD_BPE

    held = [weakref.ref(tokens.word_ids(WORD_BPE)), weakref.ref(bpe.byte_bpe(PATH))]
    gc.collect()
    assert all(x() is not None for x in held) and tokens.word_ids(WORD_BPE) is held[0]()
    common.hand_back()
    assert all(x() is None for x in held)


def test_whole_shards_read_as_single_documents():
    import numpy as np

    from tidemark.llm import repair

    draw = np.random.default_rng(5)
    words = [draw.integers(0, 40, draw.integers(1, 9)) for _ in range(30)]
    own = [np.concatenate([words[k] for k in draw.integers(0, 30, draw.integers(1, 200))]).astype("<u4") for _ in range(60)]
    shard = repair.Shard(type("Row", (), repair._shard(0, 0, 0, list(range(60)), [x.tobytes() for x in own], 40)))
    assert len(shard.left) > 10
    assert shard.read_all().tolist() == np.concatenate(own).tolist()
    assert [shard.read(d).tolist() for d in range(60)] == [x.tolist() for x in own]


WIDE = ["a　\nb  c", "x   y  z", " \n<|endoftext|> 　q", "é è é \n b c d", "日本 日本\n\n 日本　 日"]


@pytest.mark.parametrize("together", [1, 50, 1 << 20])
def test_chunks_of_many_texts_together(together, library, own, monkeypatch):
    import numpy as np

    from tidemark.llm import tokens

    monkeypatch.setattr(tokens, "TOGETHER", together)
    texts = ["", *ODD, *WIDE, *MIXED, "", *random_texts(300), "last", ""]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [(x & ~bpe.LAST).tolist() for x in own.each(texts)] == want
    digests = [d for ids, n in own.encode_all(texts) for d in own.digests(ids, n)]
    for (n, ids, text), w in zip(digests, want, strict=True):
        assert n == len(w) and ids == hashlib.sha256(",".join(map(str, w)).encode()).hexdigest()
        assert text == hashlib.sha256(library.decode(w, skip_special_tokens=False).encode()).hexdigest()
    broken = np.array([own.bytes_of.index("é".encode()[:1]), own.bytes_of.index(b"x")], "<u4")
    said = hashlib.sha256(library.decode(broken.tolist(), skip_special_tokens=False).encode()).hexdigest()
    assert own.digests(broken, np.array([2]))[0][2] == said and list(own.each([])) == []


def test_a_chunk_of_many_texts_is_looked_up_once():
    own = bpe.ByteBpe(PATH)
    looked = []
    own.known = type("Seen", (dict,), {"__getitem__": lambda self, key: looked.append(key) or own.chunk(key)})()
    assert [len(x) for x in own.each(["one two one two", "one two", " two"])] == [4, 2, 1]
    assert sorted(looked) == [" one", " two", "one"]


def test_joining_decodes_only_what_stands_at_the_cut(library, monkeypatch):
    own = bpe.ByteBpe(PATH)
    text = "many words, and more of them. " * 400
    parts = [bpe.Part(*bpe.ids_and_counts(ids)) for ids in own.each(bpe.halved(text, 2000))]
    decoded = []
    monkeypatch.setattr(own, "decoded", lambda ids, old=own.decoded: decoded.append(ids) or old(ids))
    ids = b"".join(own.tree(parts).ids)
    assert bpe.unpacked(ids) == library.encode(text, add_special_tokens=False).ids
    assert len(parts) == 8 and len(decoded) < 100
