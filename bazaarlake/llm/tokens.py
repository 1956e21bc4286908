"""Token ids of many texts with a public tokenizer, encoding each distinct piece of text once.

The tokenizers split text before they merge, so ids of pieces cut where they would split anyway are the ids of the whole.
Texts with white space whose splitting depends on what stands around it are encoded whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from bazaarlake.llm import bytewords

#: Pieces whose ids are kept for later texts, and their bytes; beyond either the store starts anew. Some texts are one piece.
STORE = 1_000_000
STORE_BYTES = 32_000_000
SLICE_BYTES = 6_000_000
#: Letters below this code point are left as they are by normalisation.
PLAIN = 0x250
#: White space other than blank and line feed, long runs of it, and the byte used as a mark.
ODD = (
    r"[\x00\t\r\x0B\x0C\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
    r"|[ \n]{3}|[ \n]{2}$"
)


@lru_cache(maxsize=1)
def letter_sign() -> str:
    """Where a letter meets a sign, the text is split by both kinds of tokenizer.

    Combining marks are no signs here: normalisation may make one letter of both. Letters whose normal form in lower case ends
    in a mark, like U+0130, are left out too: their mark is split off together with the sign behind it.
    """
    letters = (chr(c) for c in range(0x80, 0x30000) if unicodedata.category(chr(c))[0] == "L")
    marked = [c for c in letters if unicodedata.category(unicodedata.normalize("NFC", c).lower()[-1])[0] == "M"]
    return rf"([^\P{{L}}{''.join(marked)}])([\p{{P}}\p{{S}}])"


class Encoder:
    """vocabulary: a file of the public tokenizers, or a path. white_kept: whether white space becomes ids.

    special_ids: whether the string of a special token in a text becomes its id, which is the library's default, or is
    ordinary text.
    """

    def __init__(self, vocabulary: str, white_kept: bool, special_ids: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        if not os.path.exists(vocabulary):
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # in pieces; texts with their strings are encoded anew
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "(?i)" + "|".join(added) if special_ids and added else None
        self.white_kept = white_kept
        # the letters by which byte-level vocabularies write bytes
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
        # pieces of one word of ASCII letters, which byte-level vocabularies write as they are
        self.plain = "^ ?[A-Za-z]+$" if white_kept else "^[a-z]+$"
        # letters below PLAIN as those of their bytes
        self.spelled = {c: "".join(chr(self.letters[b]) for b in chr(c).encode()) for c in range(PLAIN)}
        self.forget()

    def forget(self) -> None:
        """Start the store of pieces anew: all of them, their ids one after another, and how many each has."""
        self.pieces = pa.array([], pa.large_string())
        self.flat, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merged(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and their numbers of words of plain letters, which are not normalised or split any more, only merged."""
        ids, sizes, merge = [], [], self.tokenizer.model.tokenize
        for i in range(0, len(words), 20_000):
            found = list(map(merge, words[i : i + 20_000]))
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(map(attrgetter("id"), chain.from_iterable(found)), np.uint32, int(sizes[-1].sum())))
        return ids, sizes

    def ids_of(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        ids, sizes = [], []
        for i in range(0, len(pieces), 20_000):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[i : i + 20_000], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
        return ids, sizes

    def is_plain(self, piece: str) -> bool:
        word = piece[1:] if self.white_kept and piece[:1] == " " else piece
        return word.isalpha() and ord(max(word)) < PLAIN and (self.white_kept or word == word.lower())

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of each of these distinct pieces in the store, which takes in the new ones."""
        at = pc.index_in(pieces, value_set=self.pieces)
        if len(self.pieces) + at.null_count > STORE or self.pieces.nbytes > STORE_BYTES:
            self.forget()
            at = pc.index_in(pieces, value_set=self.pieces)
        lacking = at.is_null()
        number = at.fill_null(-1).to_numpy().astype(np.int64)
        new = pieces.filter(lacking)
        if not len(new):
            return number
        plain = pc.match_substring_regex(new, self.plain)
        words, rest = new.filter(plain), new.filter(pc.invert(plain))
        ids, sizes = self.merged(pc.replace_substring(words, " ", self.spelled[0x20]).to_pylist())
        signs = rest.to_pylist()
        latin = np.fromiter(map(self.is_plain, signs), bool, len(signs))
        kinds = np.where(plain.to_numpy(zero_copy_only=False), 0, 2)
        kinds[np.flatnonzero(kinds)[latin]] = 1
        for more, many in (
            self.merged([p.translate(self.spelled) for p, whole in zip(signs, latin, strict=True) if whole]),
            self.ids_of([p for p, whole in zip(signs, latin, strict=True) if not whole]),
        ):
            ids += more
            sizes += many
        # stored by kind
        order = np.argsort(kinds, kind="stable")
        number[np.flatnonzero(lacking.to_numpy(zero_copy_only=False))[order]] = len(self.pieces) + np.arange(len(new))
        self.pieces = pa.concat_arrays([self.pieces, new.take(pa.array(order))])
        self.flat, self.size = np.concatenate([self.flat, *ids]), np.concatenate([self.size, *sizes])
        return number

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the n + 1 places where those of each begin."""
        column = column.cast(pa.large_string()).fill_null("")
        if self.white_kept:
            odd = pc.match_substring_regex(column, ODD)
            marked = pc.replace_substring(pc.replace_substring(column, " ", "\x00 "), "\n", "\x00\n\x00")
            # an odd text is one piece
            marked = pc.replace_substring_regex(marked, letter_sign(), "\\1\x00\\2")
            marked = pc.if_else(odd, pc.replace_substring(column, "\x00", "\x01"), marked)
            lists = pc.split_pattern(marked, "\x00")
        else:
            odd = None
            lower = pc.ascii_lower(pc.replace_substring(column, "\n", " "))
            lists = pc.split_pattern(pc.replace_substring_regex(lower, letter_sign(), r"\1 \2"), " ")
        coded = lists.flatten().dictionary_encode()
        number = self.numbers(coded.dictionary)
        size, first = self.size[number], (np.cumsum(self.size) - self.size)[number]
        place = coded.indices.to_numpy()
        at = lists.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        n = size[place]
        before = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(first[place] - before[:-1], n) + np.arange(before[-1])]
        edges = before[at]
        # texts that hold the mark itself, a loose dot above or the string of a special token
        if odd is None:  # a dot above belongs to a capital I, also across other marks, before it is lower-cased
            anew = pc.match_substring(column, "\u0307")
        else:
            anew = pc.and_(odd, pc.match_substring(column, "\x00"))
        if self.special:
            special = pc.match_substring_regex(column, self.special)
            anew = pc.or_(anew, special)
        if pc.any(anew).as_py():
            return self.mended(column, anew, ids, edges)
        return ids, edges

    def mended(self, column: pa.Array, anew: pa.Array, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As encode(), with some texts encoded anew as a whole."""
        parts = [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.tokenizer.encode_special_tokens = self.special is None
        for i in np.flatnonzero(anew.to_numpy(zero_copy_only=False)).tolist():
            parts[i] = np.array(self.tokenizer.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32)
        self.tokenizer.encode_special_tokens = True
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@lru_cache(maxsize=1)
def shared_encoder(vocabulary: str, white_kept: bool, special_ids: bool) -> Encoder:
    """The encoder of a worker: its later tasks find the pieces of earlier ones in the store."""
    return Encoder(vocabulary, white_kept, special_ids)


def encoded(
    batches: Iterator[pa.RecordBatch], vocabulary: str, white_kept: bool, end_id: int, special_ids: bool = False
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with a text, the ids of all their texts with end_id behind each, and the n + 1 places where each begins."""
    encoder = shared_encoder(vocabulary, white_kept, special_ids)
    for batch in batches:
        for part in bytewords.slices(batch, limit=SLICE_BYTES):
            ids, edges = encoder.encode(part.column("text"))
            yield part, np.insert(ids, edges[1:], np.uint32(end_id)), edges + np.arange(len(edges))
