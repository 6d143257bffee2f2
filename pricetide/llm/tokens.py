"""Token ids of whole texts, with the tokenizers library once per different word.

Both kinds of vocabulary cut a text at white space before anything else, so the
ids of a text are the ids of its words, one after the other.  Texts are taken many
at a time: Arrow splits them and numbers their different words, the library encodes those,
many in one call, and the ids are laid out again by the words' numbers.  Nothing is kept from
one group of texts to the next.  A text for which this would not hold (unusual white space,
the name of a special token) is encoded whole by the library.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pricetide.llm.common import worker_state

#: White space that the two sides may cut differently.
_ODD = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁤　﻿]")
_ODD_ASCII = ("\x1c", "\x1d", "\x1e", "\x1f")
_UNEVEN = ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")
_CHUNKS = re.compile(r"\s+(?!\S)| ?\S+|\s")
_LATIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
#: What stands before a key that is a piece of text as it is.
_RAW = "\n\n\n\0"
_BATCH = 500
#: Characters, or bytes, of texts that are handled at a time.
TOGETHER = 8_000_000


class Pieces:
    """Ids of many pieces, one after the other, with the first place and the number of each."""

    def __init__(self, data: np.ndarray, counts: np.ndarray):
        self.data, self.counts = data, counts
        self.firsts = np.cumsum(counts) - counts

    @classmethod
    def of(cls, encoded: list[bytes], dtype) -> "Pieces":
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded)) // dtype.itemsize
        return cls(np.frombuffer(b"".join(encoded), dtype), counts)

    def take(self, numbers: np.ndarray) -> "Pieces":
        """The pieces of these numbers, in their order and as often as they come."""
        counts = self.counts[numbers]
        moved = self.firsts[numbers] - (np.cumsum(counts) - counts)
        return Pieces(self.data[np.repeat(moved, counts) + np.arange(counts.sum())], counts)


class Encoder:
    """Ids of texts as little-endian bytes, of the width of ``dtype``.

    ``together`` bounds the characters that are encoded at a time, and so the memory.
    """

    def __init__(self, path: str, dtype: str = "<u4", together: int = TOGETHER):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype, self.together = np.dtype(dtype), together
        form = json.loads(self.tokenizer.to_str())
        self.specials = [t["content"] for t in form.get("added_tokens", [])]
        model, before = form["model"], form.get("pre_tokenizer") or {}
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values(), default=0) > np.iinfo(self.dtype).max:
            raise ValueError(f"ids of {path} do not fit {dtype}")
        plain = model.get("type") == "BPE" and not model.get("dropout")
        self.spaces_kept = (
            plain
            and form.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        self.spaces_dropped = plain and model.get("end_of_word_suffix") == "</w>" and "Lowercase" in str(
            form.get("normalizer")
        )
        marks = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, at in vocabulary.items():
            marks[at] = token.startswith("Ġ") if self.spaces_kept else token.endswith("</w>")
        self.marks = marks

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Encoded by the library, each as it is."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _runs(self, stems: list[str], led: str) -> Pieces:
        """Ids of stems, many of them at a time in one text."""
        parts = [stems[at : at + _BATCH] for at in range(0, len(stems), _BATCH)]
        texts = [led + (led or " ").join(part) for part in parts]
        data, counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, self.dtype)
            if led == "\n":
                # the line break before each stem is an id of its own, which is part of it
                starts = np.flatnonzero(ids == ids[0])
            elif self.spaces_kept:
                starts = np.flatnonzero(self.marks[ids])
            else:
                starts = np.concatenate(([0], np.flatnonzero(self.marks[ids])[:-1] + 1))
            if len(starts) == len(part):
                data.append(ids)
                counts.append(np.diff(np.append(starts, len(ids))))
            else:  # a vocabulary of another make
                plain = Pieces.of(self._whole([(led if self.spaces_kept else "") + x for x in part]), self.dtype)
                data.append(plain.data)
                counts.append(plain.counts)
        return Pieces(np.concatenate(data), np.concatenate(counts))

    def _words(self, words: pa.Array) -> Pieces:
        """Ids of different words, from their stems where they are simple.

        Simple is a word of Latin letters, perhaps with a stop or comma after it and,
        where spaces are kept, a line break before it.
        """
        fold = not self.spaces_kept
        marked = [pc.ends_with(words, x) for x in (".", ",")]
        mark_ids = [np.frombuffer(x, self.dtype) for x in self._whole([".", ","])]
        either = pc.or_(*marked) if all(len(x) == 1 for x in mark_ids) else pa.array(np.zeros(len(words), bool))
        stems = pc.if_else(either, pc.utf8_slice_codeunits(words, 0, -1), words)
        led = pa.array(np.zeros(len(words), bool)) if fold else pc.starts_with(stems, "\n")
        stems = pc.if_else(led, pc.utf8_slice_codeunits(stems, 1), stems)
        simple = pc.match_substring_regex(stems, _LATIN).to_numpy(zero_copy_only=False)
        led, either = (x.to_numpy(zero_copy_only=False) for x in (led, either))
        if fold:
            stems = pc.utf8_lower(stems)
        order, parts = [], []
        for before in (False, True):
            at = np.flatnonzero(simple & (led == before))
            different = stems.take(pa.array(at)).dictionary_encode()
            runs = self._runs(different.dictionary.to_pylist(), "\n" if before else ("" if fold else " "))
            numbers = different.indices.to_numpy(zero_copy_only=False)
            order.append(at)
            parts.append(runs.take(numbers))
        at = np.flatnonzero(~simple)
        rest = words.take(pa.array(at)).to_pylist()
        texts = [
            x[len(_RAW) :] if x.startswith(_RAW) else x if fold or not x or x.startswith("\n") else f" {x}" for x in rest
        ]
        order.append(at)
        parts.append(Pieces.of(self._whole(texts), self.dtype))
        found = Pieces(np.concatenate([x.data for x in parts]), np.concatenate([x.counts for x in parts]))
        back = np.empty(len(words), np.int64)
        back[np.concatenate(order)] = np.arange(len(words))
        found = found.take(back)
        # the mark after a stem
        after = simple & either
        counts = found.counts + after
        ends = np.cumsum(counts)
        data = np.zeros(int(counts.sum()), self.dtype)
        kept = np.ones(len(data), bool)
        kept[ends[after] - 1] = False
        data[kept] = found.data
        stops = marked[0].to_numpy(zero_copy_only=False)[after]
        if len(stops):
            data[ends[after] - 1] = np.where(stops, mark_ids[0][0], mark_ids[1][0])
        return Pieces(data, counts)

    def _kind(self, text: str) -> str:
        """How a text is cut: ``plain`` by Arrow, ``uneven`` by a pattern, ``whole`` not at all."""
        odd = any(x in text for x in _ODD_ASCII) if text.isascii() else _ODD.search(text)
        if odd or any(x in text for x in self.specials):
            return "whole"
        if self.spaces_dropped:
            return "plain"
        if not self.spaces_kept:
            return "whole"
        if text[0].isspace() or text[-1].isspace() or any(x in text for x in _UNEVEN):
            return "uneven"
        return "plain"

    @staticmethod
    def _keys(chunks: list[str]) -> list[str]:
        """Chunks as keys: a leading space is understood, everything else is marked."""
        keys = []
        for x in chunks:
            if x[0] == " " and len(x) > 1 and not x[1].isspace():
                keys.append(x[1:])
            elif x[0] == "\n":
                keys.append(x)
            else:
                keys.append(f"{_RAW}{x}")
        return keys

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, equal to those of the library's ``encode``."""
        found: list[bytes] = []
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held + len(texts[end]) <= self.together):
                held += len(texts[end])
                end += 1
            found += self._encode(texts[at:end])
            at = end
        return found

    def _encode(self, texts: list[str]) -> list[bytes]:
        kinds = [self._kind(x) if x else "" for x in texts]
        out = [b""] * len(texts)
        whole = [k for k, kind in enumerate(kinds) if kind == "whole"]
        for k, ids in zip(whole, self._whole([texts[k] for k in whole])):
            out[k] = ids
        plain = [k for k, kind in enumerate(kinds) if kind == "plain"]
        uneven = [k for k, kind in enumerate(kinds) if kind == "uneven"]
        if not plain and not uneven:
            return out
        lines = pa.array([texts[k] for k in plain], pa.large_string())
        if self.spaces_dropped:
            split = pc.ascii_split_whitespace(lines)
        else:
            # a line break before each text, too: without it the first word would be another one
            lines = pc.binary_join_element_wise(
                pa.scalar("\n", pa.large_string()), pc.replace_substring(lines, "\n", " \n"), pa.scalar("", pa.large_string())
            )
            split = pc.split_pattern(lines, " ")
        added = np.ones(len(plain), bool) if self.spaces_kept else np.zeros(len(plain), bool)
        chunks, led = [], []
        for k in uneven:
            some = _CHUNKS.findall(texts[k])
            led.append(not some[0].startswith((" ", "\n")))
            if led[-1]:
                some[0] = f"\n{some[0]}"
            chunks.append(self._keys(some))
        pieces = pa.concat_arrays([split.flatten(), pa.array([x for c in chunks for x in c], pa.large_string())])
        sizes = np.concatenate(
            (pc.list_value_length(split).to_numpy(zero_copy_only=False), [len(c) for c in chunks])
        ).astype(np.int64)
        added = np.concatenate((added, np.array(led, bool)))
        numbered = pieces.dictionary_encode()
        words = self._words(numbered.dictionary)
        laid = words.take(numbered.indices.to_numpy(zero_copy_only=False))
        edges = np.concatenate(([0], np.cumsum(laid.counts)))[np.concatenate(([0], np.cumsum(sizes)))]
        data, width = laid.data.tobytes(), self.dtype.itemsize
        for k, first, last in zip(plain + uneven, (edges[:-1] + added).tolist(), edges[1:].tolist()):
            out[k] = data[first * width : last * width]
        return out


def encoder(path: str, dtype: str) -> Encoder:
    """The worker's encoder for a vocabulary, kept between tasks."""
    kept = worker_state().setdefault("encoders", {})
    if (path, dtype) not in kept:
        kept[path, dtype] = Encoder(path, dtype)
    return kept[path, dtype]


def portions(texts: pa.Array, together: int = TOGETHER):
    """Runs of a column of texts, as first place and list, of bounded size; a null is empty."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        held = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, held + together, side="right")))
        yield at, [x or "" for x in texts.slice(at, end - at).to_pylist()]
        at = end
