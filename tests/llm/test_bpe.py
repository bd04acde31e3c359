import hashlib
import random

import pytest
from tokenizers import Tokenizer

from trowel.llm import bpe
from trowel.llm.queries import QUERIES

PATH = bpe.word_vocabulary()
WHOLE = Tokenizer.from_file(PATH)
PIECES = ["a", "b", "th", "ing", "é", "É", "ß", "1", "23", "!", "..", "<|endoftext|>", "<|startoftext|>", "'s", "İ", "Σ",
          "ő", "é", "中", "🙂", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", "\n", "the", "x" * 7, "‍", "ﬁ", "Å", "́"]


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def texts(n, seed, spaces=True):
    rng = random.Random(seed)
    for _ in range(n):
        t = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 120)))
        yield t if spaces else "".join(t.split())


@pytest.mark.parametrize("spaces", [True, False])
def test_parts_joined_equal_the_whole(spaces):
    code = bpe.coder(PATH)
    for t in texts(400, 1, spaces):
        parts = {}
        for part, piece, kind, x in bpe.cut(code, t, 20, 5):
            parts.setdefault(part, []).append((piece, kind, x))
        out = []
        for part in sorted(parts):
            own = sorted(parts[part])
            out += (code.encode_text(own[0][2]).tolist() if own[0][1] == "words" else
                    code.join_all([code.piece(x, kind == "last") for _, kind, x in own]))
        assert out == ids(t)


def test_tree_over_a_long_word():
    rng, code = random.Random(2), bpe.coder(PATH)
    word = "".join(rng.choice(["th", "er", "an", "in", "q", "zz", "aaa"]) for _ in range(5000))
    for leaf in (1, 3, 64, 999):
        cut = [word[i:i + leaf] for i in range(0, len(word), leaf)]
        assert code.join_all([code.piece(c, i + 1 == len(cut)) for i, c in enumerate(cut)]) == ids(word)


def test_encode_and_decode_against_the_library(spark):
    data = list(enumerate([None, "", " \n", "A", "a b", "w" * 3000, "ab " * 900, "é" * 900 + " " + "<|endoftext|>" * 40,
                           *texts(60, 3), *("".join(texts(12, s, s % 2)) for s in range(4))]))
    data += [(5, "twice"), (5, "twice"), (None, "no id")]
    df = spark.createDataFrame([(i, t, 0, "k") for i, t in data], "doc_id bigint, text string, part int, kind string")
    coded = bpe.decode(bpe.encode(df, PATH, part_chars=200, leaf_chars=16), PATH)
    got = sorted((r.doc_id or -1, list(r.ids), r.decoded) for r in coded.collect())
    once = bpe.encode(df, PATH, part_chars=200, leaf_chars=16, decoded=True)
    assert got == sorted((r.doc_id or -1, list(r.ids), r.decoded) for r in once.collect())
    assert got == sorted((i or -1, ids(t), WHOLE.decode(ids(t), skip_special_tokens=False)) for i, t in data)
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_query_against_the_library(spark):
    folder = "/root/testdata/sf0.001"
    known = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op9_bpe_encoding_and_decoding"](spark, folder).collect()
    assert len(got) == len(known)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in got:
        own = ids(known[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(own), sha(" ".join(map(str, own))))
        assert r.decoded_sha256 == sha(WHOLE.decode(own, skip_special_tokens=False))


def in_another_order_each_time(df):
    """The rows as a shuffle may deal them: each scan gives them in another order."""
    def mix(frames):
        for frame in frames:
            yield frame.sample(frac=1, random_state=random.SystemRandom().randrange(2**31))

    return df.coalesce(1).mapInPandas(mix, df.schema)


def test_long_rows_keep_their_ids_when_scans_differ(spark):
    data = [(i, f"w{i} " * 60) for i in range(40)]
    df = in_another_order_each_time(spark.createDataFrame(data, "doc_id bigint, text string"))
    got = bpe.encode(df, PATH, part_chars=50, leaf_chars=16, decoded=True).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == [(i, ids(t)) for i, t in data]


def test_words_of_letters_are_encoded_without_marks(monkeypatch):
    """Letters, and letters before ASCII marks, share calls of the library; only the rest goes on."""
    code, rng = bpe.Coder(PATH), random.Random(4)
    letters = ["".join(rng.choice("abcdeéß中Σ") for _ in range(rng.randint(1, 9))) for _ in range(3_000)]
    tails = ["", ".", ",", "%%%", "'", "?!", "<", "|>"]
    words = [w + rng.choice(tails) for w in letters]
    got, rest = [], code.encode_letters([w.encode() for w in dict.fromkeys(words)])
    while True:
        try:
            got.append(next(rest))
        except StopIteration as end:
            assert end.value == []
            break
    assert {w for w, _ in got} >= {w.encode() for w in words}
    for word, own in got:
        assert bpe.np.frombuffer(own, bpe.np.int32).tolist() == ids(word.decode())
    odd = ["\u0958", "İ", "a's", "a\u0301", "1.", "...", "x<|endoftext|>", "\u1100\u1161", "ﬁ.", "a\x01b", "ª,"]
    text = " ".join([*odd, *words, *(f"{w}." for w in odd)])
    for _ in range(2):  # the second time words without marks are known
        assert code.encode_text(text).tolist() == ids(text)
        text = " ".join(f"{w}.." for w in text.split())
