"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a piece of text has exactly one token sequence that BPE gives it, so one last token. A token
that ends the prefix is that last token if it may follow the last token of the prefix before it. An automaton lists
the tokens that end at each byte, a pair test decides which may follow, and the way back from the end gives the ids.
Work is linear in the text for each piece; no merge is ever replayed.
"""

import hashlib
import json
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

# Fixed value: the pattern that cuts text into pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A vocabulary file is broadcast up to this size.
MOST_BYTES = 32 << 20
# Encoded pieces a worker remembers.
CACHED = 400_000
# Characters of a text that are in memory as pieces at a time.
PART = 1 << 20
CUT = regex.compile(r"\S(?= )")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if it can be printed, else the next from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def refuse_unsupported(file: dict) -> None:
    """Raises ValueError if a vocabulary file asks for anything this encoder does not do.

    Supported is byte-level BPE over unchanged text, cut by `PIECES`, with a token for every byte. Token ids may be any below
    2^32. Steps after encoding are not looked at, as they add special tokens alone.
    """
    model, cut, back = file.get("model") or {}, file.get("pre_tokenizer") or {}, file.get("decoder") or {}
    faults = {
        "model.type": model.get("type", "BPE") != "BPE",
        **{f"model.{name}": bool(model.get(name)) for name in (
            "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")},
        "normalizer": file.get("normalizer") is not None,
        "pre_tokenizer": cut.get("type") != "ByteLevel" or cut.get("add_prefix_space", True) or not cut.get("use_regex", True),
        "decoder": back.get("type") != "ByteLevel",
        "added_tokens": any(t.get(name) for t in file.get("added_tokens") or [] for name in ("single_word", "lstrip", "rstrip")),
        "model.vocab": not byte_letters().keys() <= model.get("vocab", {}).keys()}
    found = [name for name, fault in faults.items() if fault]
    if found:
        raise ValueError(f"vocabulary file not supported: {', '.join(found)}")


class Suffixes:
    """An automaton that, fed bytes, is in the state of the longest suffix that begins a token.

    `ending` lists for each state the tokens that end there, longest first, as (size, token).
    """

    def __init__(self, tokens: dict[bytes, int]):
        edges: list[dict[int, int]] = [{}]
        own: list[tuple] = [()]
        for word, token in tokens.items():
            at = 0
            for byte in word:
                found = edges[at].get(byte)
                if found is None:
                    edges[at][byte] = found = len(edges)
                    edges.append({})
                    own.append(())
                at = found
            own[at] = ((len(word), token),)
        self.edges, self.ending, self.fall = edges, own, [0] * len(edges)
        self.step = Steps(self)
        level = list(edges[0].values())
        while level:
            below = []
            for at in level:
                for byte, child in edges[at].items():
                    self.fall[child] = self.target(self.fall[at], byte)
                    own[child] += own[self.fall[child]]
                    below.append(child)
            level = below

    def target(self, at: int, byte: int) -> int:
        while True:
            found = self.edges[at].get(byte)
            if found is not None:
                return found
            if not at:
                return 0
            at = self.fall[at]


class Steps(dict):
    """Steps of the automaton by state << 8 | byte, worked out when first taken."""

    def __init__(self, suffixes: Suffixes):
        super().__init__()
        self.suffixes = suffixes

    def __missing__(self, key: int) -> int:
        self[key] = found = self.suffixes.target(key >> 8, key & 255)
        return found


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, data: bytes):
        file, letters = json.loads(data), byte_letters()
        refuse_unsupported(file)
        model = file["model"]
        as_bytes = {word: bytes(letters[c] for c in word) for word in model["vocab"]}
        self.bytes = {number: as_bytes[word] for word, number in model["vocab"].items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.joins: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = model["vocab"][left], model["vocab"][right]
            whole = model["vocab"][left + right]
            self.joins.setdefault(pair, rank)
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = pair, rank
        self.suffixes = Suffixes({w: t for t, w in self.bytes.items() if len(w) == 1 or t in self.parts})
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens") or []}
        self.bytes |= {number: word.encode() for word, number in self.special.items()}
        self.text = {number: str(number) for number in self.bytes}
        names = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.pieces = regex.compile(PIECES)
        self.cuts = regex.compile(f"({names})") if names else None
        self.cache: dict[str, tuple[int, ...]] = {}
        self.follows: dict[int, bool] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE, given the bytes of both tokens, ends with just these two.

        Both are taken apart again, the later merge first. Seen forwards, at each state the two tokens that meet at
        the border must not join before the next merge on either side. The leftmost of equal merges goes first:
        a join at the border yields to an equal merge on its left and precedes one on its right.
        """
        known = self.follows.get(left << 32 | right)
        if known is None:
            known, limit = True, (len(self.joins), 0)
            a, b = left, right
            while True:
                joined = self.joins.get((a, b))
                if joined is not None and (joined, 1) < limit:
                    known = False
                    break
                ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
                if ra < 0 and rb < 0:
                    break
                if ra > rb:
                    limit, a = (ra, 0), self.parts[a][1]
                else:
                    limit, b = (rb, 2), self.parts[b][0]
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            self.follows[left << 32 | right] = known
        return known

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of a piece."""
        ids = self.cache.get(text)
        if ids is None:
            ids = (self.special[text],) if text in self.special else self._solve(text.encode("utf-8", "replace"))
            if len(self.cache) >= CACHED:
                self.cache.clear()
            if len(text) < 64:
                self.cache[text] = ids
        return ids

    def _solve(self, data: bytes) -> tuple[int, ...]:
        """The unique last token of each prefix, then the way back."""
        last = [0] * (len(data) + 1)
        sizes = [0] * (len(data) + 1)
        known, test = self.follows.get, self.may_follow
        step, ending, state = self.suffixes.step, self.suffixes.ending, 0
        for end, byte in enumerate(data, 1):
            state = step[state << 8 | byte]
            for size, token in ending[state]:
                start = end - size
                if start:
                    if not sizes[start]:
                        continue
                    before = last[start]
                    fits = known(before << 20 | token)
                    if not (test(before, token) if fits is None else fits):
                        continue
                last[end], sizes[end] = token, size
                break
        ids, end = [], len(data)
        while end:
            ids.append(last[end])
            end -= sizes[end]
        ids.reverse()
        return tuple(ids)

    def _parts(self, text: str):
        """The text in parts that end where a piece ends, of about `PART` characters: a piece that holds a space begins
        with it or is all space, so pieces end before a space that follows something else. Special tokens are parts."""
        if self.cuts is not None and any(s in text for s in self.special):
            yield from chain.from_iterable(
                (part,) if part in self.special else self._parts(part) for part in self.cuts.split(text))
            return
        start = 0
        while len(text) - start > 2 * PART:
            found = CUT.search(text, start + PART)
            if found is None:
                break
            yield text[start:found.start() + 1]
            start = found.start() + 1
        yield text[start:]

    def blocks(self, text: str):
        """Ids of a text, a part at a time."""
        get, slow = self.cache.get, self.piece
        for part in self._parts(text):
            pieces = (part,) if part in self.special else self.pieces.findall(part)
            yield list(chain.from_iterable([get(p) or slow(p) for p in pieces]))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.blocks(text)))

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def loaded(data: bytes) -> Bpe:
    """One encoder per worker and vocabulary."""
    return Bpe(data)


def vocabulary(spark, path: str):
    """The file at `path` on the driver, broadcast. Files over `MOST_BYTES` are refused."""
    with open(path, "rb") as file:
        data = file.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"{path} is larger than {MOST_BYTES} bytes")
    refuse_unsupported(json.loads(data))
    return spark.sparkContext.broadcast(data)


def encode_decode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every text.

    One pass, no shuffle. A null text counts as empty: no tokens, and the hashes of nothing. Rows with null or repeated
    doc_id are kept, each on its own; other columns are ignored. Long texts are encoded block by block. No rows give none, and
    equal texts equal ids. ValueError if the file is over `MOST_BYTES` or asks for what is not supported.
    """
    data = vocabulary(docs.sparkSession, path)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches):
        bpe = loaded(data.value)
        as_text, as_bytes = bpe.text.__getitem__, bpe.bytes.__getitem__
        for batch in batches:
            rows = []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count, ids_sha, text_sha, kept = 0, hashlib.sha256(), hashlib.sha256(), []
                for ids in bpe.blocks(text or ""):
                    ids_sha.update(("," if count else "").encode() + ",".join(map(as_text, ids)).encode())
                    text_sha.update(b"".join(map(as_bytes, ids)))
                    count += len(ids)
                    if with_ids:
                        kept += ids
                rows.append((number, count, ids_sha.hexdigest(), text_sha.hexdigest(), *([kept] if with_ids else [])))
            columns = list(zip(*rows)) if rows else [()] * (5 if with_ids else 4)
            arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                      pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays.append(pa.array(columns[4], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    from pageflow.llm.common import prepared, table

    return encode_decode(table(prepared(spark), sf_dir, "documents"), default_path())
