"""SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is read field by field and rebuilt: normaliser (character map, blank
handling), metaspace marker, unigram scores or BPE merges, byte fallback. The driver reads the file
once and broadcasts its bytes, so executors need no copy of it. Each task encodes batches of bounded
size with the library's own threads.

Words are encoded on their own where the vocabulary allows it: no piece continues past a marker. A
text with runs of blanks is split before each run instead of each marker, as pieces may hold
several markers.

Defined results: a null text is empty; an empty text has no ids. Decoding gives the text back but
for what the model's normaliser changes and literal markers, which read as blanks; ``round_trip``
compares with the text so changed. Repeated rows give equal results.
"""

from __future__ import annotations

import os
import re
import struct
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm import tools

MARK = "▁"
#: Numbers of the protobuf's enumerations.
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
UNIGRAM, BPE = 1, 2
_BYTE_NAME = re.compile("<0x[0-9A-Fa-f]{2}>")
_UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Bound on the remembered stretches of a worker, about 200 bytes each.
REMEMBERED = 300_000
#: Stretches that are joined into one call.
GROUP = 50


def fields(data: bytes):
    """(number, value) of each field; a value is an int, or the bytes of a longer field."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What a model file says."""

    data: bytes

    @cached_property
    def pieces(self) -> list[tuple[str, float, int]]:
        found = []
        for number, value in fields(self.data):
            if number == 1:
                own = dict(fields(value))
                found.append((own.get(1, b"").decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        return found

    def part(self, number: int) -> dict:
        return next((dict(fields(v)) for n, v in fields(self.data) if n == number), {})

    @cached_property
    def kind(self) -> int:
        return self.part(2).get(3, UNIGRAM)

    @cached_property
    def normaliser(self) -> dict:
        own = self.part(3)
        return {"map": own.get(2, b""), "prefix": own.get(3, 1), "trim": own.get(4, 1)}

    @cached_property
    def splittable(self) -> bool:
        """No usable piece has a marker after another character."""
        return not any(MARK in piece.lstrip(MARK) for piece, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED))


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """All pairs of pieces that make a piece, the best-scored result first."""
    usable = {piece: (score, i) for i, (piece, score, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, (score, _) in usable.items():
        for cut in range(1, len(piece)):
            if piece[:cut] in usable and piece[cut:] in usable:
                found.append((-score, usable[piece[:cut]][1], usable[piece[cut:]][1], piece[:cut], piece[cut:]))
    return [pair[3:] for pair in sorted(found)]


class Numbers(dict):
    """Stretches by number. One not met before gets the next number and is noted in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.new.append(unit)
        return number


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one span after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def bounds(sizes) -> np.ndarray:
    """Where rows of these sizes begin, and the end of the last."""
    return np.concatenate(([0], np.cumsum(np.asarray(sizes, np.int64))))


class Codec:
    def __init__(self, data: bytes):
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        self.model = model = Model(data)
        unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
        fallback = any(p[2] == BYTE for p in model.pieces)
        if model.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, fallback)
        elif model.kind == BPE:
            vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
            core = models.BPE(vocabulary, merges(model.pieces), unk_token=None if unknown is None else model.pieces[unknown][0], fuse_unk=True, byte_fallback=fallback)
        else:
            raise ValueError("only unigram and BPE models can be rebuilt")
        own, steps = model.normaliser, []
        if own["map"]:
            steps.append(normalizers.Precompiled(own["map"]))
        if own["trim"]:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if own["prefix"]:
            steps.append(normalizers.Prepend(MARK))
        steps.append(normalizers.Replace(" ", MARK))
        self.normaliser = normalizers.Sequence(steps)
        self.plain_text = not own["map"] and not own["trim"]
        self.core, self.joined = Tokenizer(core), Tokenizer(core)
        self.joined.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        plain = (NORMAL, USER_DEFINED)
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(MARK, " ").encode() if kind in plain and not _BYTE_NAME.fullmatch(piece) else None for piece, _, kind in model.pieces
        ]
        self.piece_bytes = np.frombuffer(b"".join(b or b"" for b in self.bytes_of), np.uint8)
        self.piece_sizes = np.array([len(b or b"") for b in self.bytes_of], np.int64)
        self.piece_starts = bounds(self.piece_sizes)[:-1]
        self.opening = np.array([kind in plain and piece[:1] == MARK for piece, _, kind in model.pieces])
        self.no_bytes = np.array([b is None for b in self.bytes_of])
        self.core.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        self.forget()

    def normalised(self, text: str) -> str:
        if not text:
            return text
        if self.plain_text:
            return (MARK if self.model.normaliser["prefix"] else "") + text.replace(" ", MARK)
        return self.normaliser.normalize_str(text)

    def split(self, text: str) -> list[str]:
        """The stretches of a normalised text that are encoded on their own."""
        if not self.model.splittable:
            return [text] if text else []
        if MARK + MARK in text:
            return _UNITS.findall(text)
        if not text or " " in text:
            first, *rest = text.split(MARK)
            return ([first] if first else []) + [MARK + x for x in rest]
        parts = text.replace(MARK, " " + MARK).split(" ")
        return parts if parts[0] else parts[1:]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of each text, and whether decoding them gives the normalised text back."""
        ids, rows, round_trip = self.encode_flat(texts)
        every = ids.tolist()
        return [every[low:high] for low, high in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)], round_trip

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """What ``encode`` returns, the ids one text after another and the bounds of the texts.

        Stretches not met before go to the library in one batch, for its threads; what they gave is
        remembered, up to ``REMEMBERED`` of them.
        """
        wanted = [self.normalised(t) for t in texts]
        parts = [self.split(t) for t in wanted]
        units = bounds([len(p) for p in parts])
        numbers = np.fromiter(map(self.units.__getitem__, chain.from_iterable(parts)), np.int64, units[-1])
        self._learn()
        sizes = self.sizes[numbers]
        ids, rows = self.ids[spans(self.starts[numbers], sizes)], bounds(sizes)[units]
        if len(self.units) > REMEMBERED:
            self.forget()
        return ids, rows, self._round_trip(ids, rows, wanted)

    def forget(self) -> None:
        self.units = Numbers()
        #: Ids of all stretches, and where those of each begin and how many they are.
        self.ids, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self) -> None:
        """Encode the new stretches; those with one leading marker are joined, as each call has its price."""
        new, self.units.new = self.units.new, []
        if not new:
            return
        alone = np.array([u[0] == MARK and u.count(MARK) == 1 for u in new])
        simple, others = [u for u, is_simple in zip(new, alone, strict=True) if is_simple], [u for u, is_simple in zip(new, alone, strict=True) if not is_simple]
        groups = [simple[i : i + GROUP] for i in range(0, len(simple), GROUP)]
        ids = [np.array(e.ids, np.int32) for e in self.joined.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)]
        counts = [self._counts(group, own) for group, own in zip(groups, ids, strict=True)]
        rest = self.core.encode_batch_fast(others, add_special_tokens=False)
        ids += [np.array(e.ids, np.int32) for e in rest]
        sizes, places = np.empty(len(new), np.int64), np.concatenate((np.flatnonzero(alone), np.flatnonzero(~alone)))
        sizes[places] = np.concatenate([*counts, np.array([len(e) for e in rest], np.int64)])
        starts = np.empty(len(new), np.int64)
        starts[places] = bounds(sizes[places])[:-1] + len(self.ids)
        self.ids, self.starts, self.sizes = np.concatenate([self.ids, *ids]), np.concatenate((self.starts, starts)), np.concatenate((self.sizes, sizes))

    def _counts(self, group: list[str], ids: np.ndarray) -> np.ndarray:
        """How many ids each stretch of a group has. The marker is its first character and in no other place, so a piece with a marker opens it."""
        opens = np.flatnonzero(self.opening[ids])
        if len(opens) == len(group):
            return np.diff(opens, append=len(ids))
        (slow,) = self.joined.encode_batch(["".join(group)], add_special_tokens=False)  # the marker is no piece of its own
        return np.bincount(np.array(slow.word_ids, np.int64), minlength=len(group))

    def _round_trip(self, ids: np.ndarray, rows: np.ndarray, wanted: list[str]) -> list[bool]:
        """Whether the ids of each row decode to its text; what is not so byte by byte is decoded once more by ``decode``."""
        sizes = self.piece_sizes[ids]
        got = self.piece_bytes[spans(self.piece_starts[ids], sizes)].tobytes()
        cuts, unknown = bounds(sizes)[rows].tolist(), bounds(self.no_bytes[ids])[rows]
        texts = [t.replace(MARK, " ") for t in wanted]
        same = [got[low:high] == t.encode() for t, low, high in zip(texts, cuts[:-1], cuts[1:], strict=True)]
        left = [i for i, equal in enumerate(same) if not equal or unknown[i] != unknown[i + 1]]
        for i, text in zip(left, self.decode([ids[rows[i] : rows[i + 1]].tolist() for i in left]), strict=True):
            same[i] = text == self._unmarked(texts[i])
        return same

    def _unmarked(self, text: str) -> str:
        return text[1:] if self.model.normaliser["prefix"] and text[:1] == " " else text

    def decode(self, ids: list[list[int]]) -> list[str]:
        """The text of each list; lists with control pieces or broken bytes go to the library."""
        texts: list[str | None] = []
        for own in ids:
            try:
                texts.append(b"".join(map(self.bytes_of.__getitem__, own)).decode())
            except (TypeError, UnicodeDecodeError):
                texts.append(None)
        left = [i for i, t in enumerate(texts) if t is None]
        for i, text in zip(left, self.core.decode_batch([ids[i] for i in left], skip_special_tokens=False) if left else [], strict=True):
            texts[i] = text
        return [self._unmarked(t) for t in texts]


def reference(data: bytes):
    """The same model in its own library, to verify against."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


_codecs: dict[int, Codec] = {}


def codec_of(data: bytes) -> Codec:
    """One codec for each model and Python worker."""
    if hash(data) not in _codecs:
        _codecs[hash(data)] = Codec(data)
    return _codecs[hash(data)]


def encoded(docs: DataFrame, model_path: str, threads: int = 2, parity_share: int = 1) -> DataFrame:
    """docs and three columns: ``ids``, ``round_trip`` and ``parity``.

    ``round_trip`` decodes the row's ids. ``parity`` compares them with the model's own library,
    once for equal texts of a chunk. 1 for ``parity_share`` verifies all rows, 0 none, more than 1
    one in so many rows by the text's hash; parity is null for rows left out.
    """
    tools.small_batches(docs.sparkSession)
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    own = ("ids", "round_trip", "parity")
    schema = docs.drop(*own).withColumn("ids", F.lit(None).cast("array<int>")).withColumn("round_trip", F.lit(True)).withColumn("parity", F.lit(None).cast("boolean")).schema
    columns = [c for c in docs.columns if c not in own]

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        codec, judge = codec_of(shared.value), None
        for batch in batches:
            texts = [t or "" for t in batch["__text"].to_pylist()]
            checked = batch["__checked"].to_pylist()
            for part in tools.chunks([len(t) for t in texts]):
                some = texts[part]
                ids, cuts, round_trip = codec.encode_flat(some)
                parity: list[bool | None] = [None] * len(some)
                distinct = list({t: None for t, wanted in zip(some, checked[part], strict=True) if wanted})
                if distinct:
                    judge = judge or reference(shared.value)
                    right = dict(zip(distinct, judge.encode(distinct, num_threads=1), strict=True))
                    every, at = ids.tolist(), cuts.tolist()
                    parity = [right[t] == every[low:high] if wanted else None for t, low, high, wanted in zip(some, at[:-1], at[1:], checked[part], strict=True)]
                rows = batch.slice(part.start, len(some)).select(columns)
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, lists, pa.array(round_trip), pa.array(parity, pa.bool_())], [*columns, *own])
        codec.forget()  # the worker may live on for other stages

    check = F.lit(False) if not parity_share else F.xxhash64("__text") % parity_share == 0
    return docs.drop(*own).withColumn("__text", F.col("text").cast("string")).withColumn("__checked", check).mapInArrow(run, schema)
