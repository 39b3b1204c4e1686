"""Token ids of whole texts, a word at a time.

The lower-casing word BPE drops white space and never merges across it, so a
text's ids are the ids of its white-space-separated words in order. A batch's
distinct words, less case and outer punctuation, are encoded by the tokenizer
once in a worker's life (as far as its memory goes) and gathered back with numpy.
Only ASCII white space separates here; other white space stays inside a word
and is left to the tokenizer.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

WORD_BPE = "word_bpe_49k.json"
_KEPT_WORDS = 500_000
_ENCODED_AT_ONCE = 10_000
# A word is cut into signs, a core and signs where the tokenizer always cuts: the core begins and ends
# with a letter or digit that lower-cases to one, and the signs hold no apostrophe (contractions) and
# are no part of a special token. Words of another form are one part.
_SIGNS = r"[!-&(-/:;=?@\[-`{}~]*"
_EDGE = r"[A-Za-z0-9À-ÖØ-öø-ÿ]"
_PARTS = rf"^(?P<lead>{_SIGNS})(?P<core>{_EDGE}(?:[^<|]*{_EDGE})?)(?P<trail>{_SIGNS})$"


def gather(flat: np.ndarray, lengths: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``index`` of a ragged array one after the other, and the end of each."""
    starts = np.cumsum(lengths) - lengths
    sizes = lengths[index]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts[index] - (ends - sizes), sizes) + np.arange(total)
    return flat[at], ends


class WordEncoder:
    """Ids as the tokenizers library gives them, without special tokens, truncation or padding."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if "Lowercase" not in normal or spec["model"].get("end_of_word_suffix") != "</w>":
            raise ValueError(f"{path} is no lower-casing BPE with word ends; words cannot be encoded one by one")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _ids(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ragged ids (flat, lengths) of what is known by now, and the places of ``parts`` there."""
        place = pc.index_in(parts, value_set=self.known)
        if place.null_count and len(self.known) + place.null_count > _KEPT_WORDS:
            self._forget()
            place = pc.index_in(parts, value_set=self.known)
        unknown = pc.is_null(place)
        at = place.fill_null(0).to_numpy().astype(np.int64)
        if place.null_count:
            new = parts.filter(unknown)
            at[unknown.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
            ids = []
            for start in range(0, len(new), _ENCODED_AT_ONCE):  # an encoding is far larger than its ids
                some = new.slice(start, _ENCODED_AT_ONCE).to_pylist()
                ids.extend(e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False))
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            self.known = pa.concat_arrays([self.known, new])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, flat])
        return self.flat, self.lengths, at

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty), each text closed by ``end_id``, and the end of each text."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        cut = pc.extract_regex(words.dictionary, _PARTS)
        whole = pc.is_null(cut)
        core = pc.if_else(whole, words.dictionary, pc.ascii_lower(pc.struct_field(cut, "core")))
        parts = pa.concat_arrays([pc.struct_field(cut, "lead").fill_null(""), core, pc.struct_field(cut, "trail").fill_null("")])
        parts = parts.dictionary_encode()
        flat, lengths, place = self._ids(parts.dictionary)
        # The ids of each distinct word: those of its three parts.
        three = place[parts.indices.to_numpy().reshape(3, -1).T.reshape(-1)]
        by_word, ends = gather(flat, lengths, three)
        found, ends = gather(by_word, np.diff(ends[2::3], prepend=0), words.indices.to_numpy())
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets = offsets[1:] - offsets[0]
        ends = np.concatenate(([0], ends))[offsets]
        ends = ends + np.arange(1, len(ends) + 1)
        out = np.empty(len(found) + len(ends), np.uint32)
        mask = np.ones(len(out), bool)
        mask[ends - 1] = False
        out[mask] = found
        out[ends - 1] = end_id
        return out, ends


@lru_cache(maxsize=2)
def word_encoder(path: str | None = None) -> WordEncoder:
    """The worker's encoder; made once per Python worker."""
    return WordEncoder(path or public_tokenizers.path(WORD_BPE))
