"""BPE encoding and decoding; long texts are encoded in parts and the parts' ends mended.

White space parts words, so a text may be cut there and its parts encoded alone. A long word
without such a place is cut anywhere: its pieces are encoded in parallel and joined as a tree.
At each join a window of tokens on both sides is encoded again, and grows until its first and
last token are those that stood there before. Then each two neighbours in the joined list also
are neighbours in the encoding of some text, which holds for one list of tokens only: the
encoding of the whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trowel.llm.common import read, sha256_hex, stored

PART_CHARS = 32_768  # texts longer than this are cut and encoded as several rows
LEAF_CHARS = 8_192   # pieces of a long word, in characters of the vocabulary's byte alphabet
CACHE_WORDS = 300_000   # words whose ids a worker remembers, and as many that it knew before
MARKS = string.punctuation  # ASCII marks, which may stand behind a word
MARK = "\x01"           # stands between words that are encoded together
BATCH_CHARS = 500_000  # texts that a worker gives back together


class Coder:
    """A vocabulary file with what the parts need: encoding of words at and before their end."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        model = held["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("a plain BPE vocabulary is needed")
        self.path, self.suffix = path, model.get("end_of_word_suffix") or ""
        self.special = [t["content"] for t in held["added_tokens"]]
        self.specials = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.tokens = {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        mark = self.whole.encode(f"a {MARK} b", add_special_tokens=False).ids
        self.mark = mark[1] if len(mark) == 3 else None
        self.tails: dict[str, bytes | None] = {}
        # every letter of the byte alphabet can end a word: then no word is without such a token
        ending = bool(self.suffix) and all(f"{c}{self.suffix}" in model["vocab"] for c in ByteLevel.alphabet())
        self.ends = np.array([ending and self.tokens.get(i, "").endswith(self.suffix)
                              for i in range(max(self.tokens) + 1)])

    @functools.cached_property
    def models(self):
        """Models of pieces before a word's end and at it; only long words need them."""
        from tokenizers import models

        with open(self.path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return (models.BPE(model["vocab"], merges),
                models.BPE(model["vocab"], merges, end_of_word_suffix=self.suffix or None))

    def encode_new(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each word with its ids as bytes of int32. One call of the library encodes many words.
        Words of letters end where a token ends a word; others have a mark between them, and words
        that hold the mark are encoded alone."""
        words = yield from self.encode_letters(words)
        alone = [w for w in words if self.mark is None or MARK.encode() in w]
        found = self.whole.encode_batch_fast([w.decode() for w in alone], add_special_tokens=False)
        yield from ((w, np.array(e.ids, np.int32).tobytes()) for w, e in zip(alone, found))
        together = [w for w in words if self.mark is not None and MARK.encode() not in w]
        for start in range(0, len(together), 5_000):
            held = together[start:start + 5_000]
            text = f" {MARK} ".join([w.decode() for w in held])
            ids = np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            if len(ends) != len(held):
                raise ValueError("the vocabulary splits marked words differently")
            starts = np.append(0, ends[:-1] + 1)
            yield from ((w, ids[a:b].tobytes()) for w, a, b in zip(held, starts, ends))

    def encode_letters(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Words of letters, or letters before ASCII marks, with their ids; returns those still to
        be encoded. Letters alone give one token or more that ends a word, so if there are as many
        of them as words, each has one; if not, as some letters are taken apart, the words of that
        call are left. Marks that the library parts from letters have ids of their own."""
        if not self.ends.any():
            return words
        left, letters, marked = [], {}, []
        for word in words:
            text = word.decode()
            stem = text.rstrip(MARKS)
            if not stem.isalpha():
                left.append(word)
            elif len(stem) == len(text):
                letters[word] = text
            elif self.tail(text[len(stem):]) is None or (self.specials and self.specials.search(text)):
                left.append(word)
            else:
                own = stem.encode()
                marked.append((word, own, text[len(stem):]))
                if own not in self.words and own not in self.older:
                    letters[own] = stem
        found, every = {}, list(letters)
        for start in range(0, len(every), 1_000):
            own = every[start:start + 1_000]
            text = " ".join([letters[w] for w in own])
            ids = np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) == len(own) and ends[-1] == len(ids):
                data, size = ids.tobytes(), ids.itemsize
                found.update((w, data[size * a:size * b]) for w, a, b in zip(own, [0, *ends], ends))
        wanted = set(words)
        left += [w for w in every if w in wanted and w not in found]
        yield from found.items()
        for word, stem, tail in marked:
            ids = found.get(stem)
            if ids is None:  # known, but perhaps as letters that are taken apart
                ids = self.words.get(stem) or self.older.get(stem)
                if ids is None or self.ends[np.frombuffer(ids, np.int32)].sum() != 1:
                    left.append(word)
                    continue
            yield word, ids + self.tail(tail)
        return left

    def tail(self, marks: str) -> bytes | None:
        """The ids of ASCII marks behind letters, as bytes; None if letters and marks are not parted."""
        if marks not in self.tails:
            own, letter, both = (e.ids for e in self.whole.encode_batch_fast(
                [marks, "a", f"a{marks}"], add_special_tokens=False))
            self.tails[marks] = np.array(own, np.int32).tobytes() if letter + own == both else None
        return self.tails[marks]

    def encode_texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text. Words are remembered; when there are too many of them, those
        not met again since the last time are forgotten."""
        split = [(t or "").encode().split() for t in texts]  # bytes: ASCII white space only
        need = set().union(*split)
        if len(self.words) > CACHE_WORDS:
            self.older, self.words = self.words, {}
        known, older = self.words, self.older
        new = [w for w in need if w not in known]
        known.update([(w, older[w]) for w in new if w in older])
        known.update(self.encode_new([w for w in new if w not in older]))
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in split]

    def encode_text(self, text: str | None) -> np.ndarray:
        return self.encode_texts([text])[0]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """The text of each list of ids; without a decoder, the tokens joined by spaces."""
        if self.whole.decoder is not None:
            return self.whole.decode_batch(ids, skip_special_tokens=False)
        token = self.tokens.__getitem__
        return [" ".join(map(token, i)) for i in ids]

    def piece(self, text: str, last: bool) -> list[int]:
        """The ids of a piece of one word, in the byte alphabet."""
        return [t.id for t in self.models[last].tokenize(text)] if text else []

    def chars(self, token: int) -> str:
        text = self.tokens[token]
        return text.removesuffix(self.suffix) if self.suffix else text

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The ids of a text whose halves have these; ``last``: it ends a word."""
        if not left or not right:
            return left or right
        reach = 2
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            text = "".join(map(self.chars, left[a:])) + "".join(map(self.chars, right[:b]))
            at_end = b == len(right)
            window = self.piece(text, last and at_end)
            if ((a == 0 or window[0] == left[a]) and (at_end or window[-1] == right[b - 1])):
                return left[:a] + window + right[b:]
            reach *= 2

    def join_all(self, pieces: list[list[int]]) -> list[int]:
        """Pieces of one word, joined two by two until one is left."""
        while len(pieces) > 1:
            pieces = [self.join(pieces[i], pieces[i + 1], i + 2 >= len(pieces))
                      if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
        return pieces[0] if pieces else []

    def cut_run(self, run: str, leaf_chars: int) -> Iterator[tuple[bool, list[str]]]:
        """A long text without white space as (False, [text to encode as it is]) and
        (True, [pieces of one word])."""
        at = 0
        marks = [m.span() for m in self.specials.finditer(run)] if self.specials else []
        for start, end in [*marks, (len(run), len(run))]:
            part = run[at:start]
            if len(part) <= leaf_chars:
                yield False, [part]
            else:  # the same steps that the library takes
                text = self.whole.normalizer.normalize_str(part) if self.whole.normalizer else part
                for word, _ in self.whole.pre_tokenizer.pre_tokenize_str(text):
                    yield True, [word[i:i + leaf_chars] for i in range(0, len(word), leaf_chars)]
            if end > start:
                yield False, [run[start:end]]
            at = end


@functools.cache
def coder(path: str) -> Coder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
    return Coder(path)


def cut(code: Coder, text: str, part_chars: int, leaf_chars: int) -> Iterator[tuple[int, int, str, str]]:
    """Rows (part, piece, kind, text) of a long text: stretches of whole words up to about
    ``part_chars`` (kind words), and the pieces of long words (inner, or last at a word's end)."""
    part, held, size = 0, [], 0
    for word in map(bytes.decode, text.encode().split()):
        if len(word) <= part_chars:
            held.append(word)
            size += len(word) + 1
            if size < part_chars:
                continue
        if held:
            yield part, 0, "words", " ".join(held)
            part, held, size = part + 1, [], 0
        if len(word) > part_chars:
            for is_word, pieces in code.cut_run(word, leaf_chars):
                for n, piece in enumerate(pieces):
                    kind = "words" if not is_word else "last" if n + 1 == len(pieces) else "inner"
                    yield part, n, kind, piece
                part += 1
    if held:
        yield part, 0, "words", " ".join(held)


def _lots(batch: pa.RecordBatch, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about BATCH_CHARS, so that a worker holds little at a time."""
    first = held = 0
    for i, size in enumerate(sizes):
        held += size
        if held >= BATCH_CHARS or i + 1 == len(sizes):
            yield batch.slice(first, i + 1 - first)
            first, held = i + 1, 0


def _list_array(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(lists) if lists else np.empty(0, np.int32))


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           part_chars: int = PART_CHARS, leaf_chars: int = LEAF_CHARS, decoded: bool = False) -> DataFrame:
    """Every row's ids: (doc_id, ids), as the tokenizers library encodes the whole text with
    ``vocabulary`` and without added special tokens; and if ``decoded`` their text again, in a
    column of that name.

    Texts up to ``part_chars`` code points are encoded in the scan. Longer ones are numbered and
    stored, as two plans read their numbers; they are cut, their parts spread over the tasks, and
    the ids put together again by row. The vocabulary file is
    read on the executors, where ``vocabulary`` must be readable. Decoding in the same pass keeps
    one worker for each task in place of two.

    Defined cases: null and empty texts, and ones of white space only, have no ids; ids may be
    null or repeat, each row has its own result; an empty table gives an empty one; the ids of
    a single row are held in one task.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > part_chars
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    names = [f.name for f in fields]

    def short_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(vocabulary)
        for batch in batches:
            for lot in _lots(batch, pc.fill_null(pc.utf8_length(batch["text"]), 0).to_pylist()):
                ids = code.encode_texts(lot["text"].to_pylist())
                texts = [pa.array(code.decode([i.tolist() for i in ids]), pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([lot["doc_id"], _list_array(ids), *texts],
                                                 ["doc_id", *names])
            pa.default_memory_pool().release_unused()

    def cut_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = coder(vocabulary)
        for frame in frames:
            for text, row_no in zip(frame.text, frame.row_no):
                out = pd.DataFrame(cut(code, text, part_chars, leaf_chars),
                                   columns=["part", "piece", "kind", "text"])
                out["row_no"] = row_no
                yield out

    def part_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(vocabulary)
        for batch in batches:
            for lot in _lots(batch, pc.utf8_length(batch["text"]).to_pylist()):
                ids = [code.encode_text(t) if k == "words" else np.array(code.piece(t, k == "last"), np.int32)
                       for k, t in zip(lot["kind"].to_pylist(), lot["text"].to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [lot["row_no"], lot["part"], lot["piece"], lot["kind"], _list_array(ids)],
                    ["row_no", "part", "piece", "kind", "ids"])

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        code, out = coder(vocabulary), []
        for _, own in frame.sort_values(["part", "piece"]).groupby("part", sort=True):
            out.append(own.ids.iloc[0] if own.kind.iloc[0] == "words"
                       else code.join_all([i.tolist() for i in own.ids]))
        ids = np.concatenate(out).astype(np.int32)
        texts = {"decoded": code.decode([ids.tolist()])} if decoded else {}
        return pd.DataFrame({"row_no": [int(frame.row_no.iloc[0])], "ids": [ids], **texts})

    short = rows.where(~long).select("doc_id", "text").mapInArrow(
        short_ids, T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *fields]))
    numbered = stored(rows.where(long).withColumn("row_no", F.monotonically_increasing_id()), "long")
    parts = numbered.select("text", "row_no").mapInPandas(
        cut_rows, "part int, piece int, kind string, text string, row_no bigint")
    spread = parts.repartition("row_no", "part", "piece").mapInArrow(
        part_ids, "row_no bigint, part int, piece int, kind string, ids array<int>")
    whole = spread.groupBy("row_no").applyInPandas(
        joined, T.StructType([T.StructField("row_no", T.LongType()), *fields]))
    # a long text of white space only has no part
    none = F.array().cast("array<int>")
    long_ids = numbered.select("doc_id", "row_no").join(whole, "row_no", "left").select(
        "doc_id", F.coalesce("ids", none).alias("ids"),
        *[F.coalesce("decoded", F.lit("")).alias("decoded")] * decoded)
    return short.union(long_ids)


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "ids", to_col: str = "decoded") -> DataFrame:
    """The rows with the text of their ids in ``to_col``, as the library's decode gives it with
    special tokens kept; null or no ids give the empty text. An input column of that name is
    replaced."""
    kept = [c for c in encoded.columns if c != to_col]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(vocabulary)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch[ids_col]), 0).to_pylist()
            for lot in _lots(batch, [4 * n for n in sizes]):
                out = code.decode([x.values.to_numpy().tolist() if x.is_valid else [] for x in lot[ids_col]])
                yield pa.RecordBatch.from_arrays(
                    [*[lot[c] for c in kept], pa.array(out, pa.string())], [*kept, to_col])

    schema = T.StructType([*[encoded.schema[c] for c in kept], T.StructField(to_col, T.StringType())])
    return encoded.select(*kept).mapInArrow(texts, schema)


def digests(coded: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Counts and digests of (doc_id, ids, decoded), with the ids themselves if asked for."""
    return coded.select(
        "doc_id", *(["ids"] if keep_ids else []), F.size("ids").cast("bigint").alias("n_tokens"),
        sha256_hex(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"))


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe_encoding_and_decoding(spark, folder: str) -> DataFrame:
    path = word_vocabulary()
    return digests(encode(read(spark, folder, "documents"), path, decoded=True))
