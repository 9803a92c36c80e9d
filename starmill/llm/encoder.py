"""Token ids by the tokenizers library, with the ids of recent words kept.

Texts repeat their words, and encoding is far dearer than a look-up. A text is cut where
its tokenizer never joins across, so that the ids of the parts are the ids of the whole:

* ``spaces="drop"``: for vocabularies whose pre-tokenizer removes white space. The parts
  are the words between spaces and line feeds.
* ``spaces="lead"``: for byte-level vocabularies that put a space before the word it
  leads. The cut is before a space or a line feed that stands alone between two other
  characters; longer runs of white space stay within a part.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LEADING = re.compile(r" (?=\S)")
# Each of these is neither letter, digit nor white space to any of the pre-tokenizers.
_ENDINGS = ".,;:!?#*$%&"
_JOINED = 256
# Words of a generation; a word and its ids take about 200 bytes.
KEPT_WORDS = 400_000
# How the two kinds of vocabulary write the end of a word, a space and a line feed.
_WORD_END, _SPACE, _LINE = "</w>", "\u0120", "\u010a"


def _normal(word: str) -> str:
    """A word as a vocabulary may normalise it. Some letters become a letter and a mark,
    which are two pre-tokens."""
    return unicodedata.normalize("NFC", word).lower()


class WordEncoder:
    """Encode texts to little-endian unsigned 32-bit ids.

    Ids of words are kept in two generations; once the young one holds ``kept`` words it
    becomes the old one, and words still in use move over. The words of a call are
    made unique first, so that each is looked up once, and the ids of the texts are
    gathered from the unique words as arrays.
    """

    def __init__(self, path: str, spaces: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if spaces not in ("drop", "lead"):
            raise ValueError(f"spaces must be 'drop' or 'lead', not {spaces!r}")
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = json.loads(Path(path).read_text(encoding="utf-8"))
        # A text that holds the name of such a token is encoded whole.
        self.names = [t["content"] for t in vocabulary["added_tokens"]]
        self.lead, self.kept = spaces == "lead", kept
        words = self.tokenizer.get_vocab(True)
        self.edge = np.zeros(max(words.values()) + 1, bool)
        for token, number in words.items():
            self.edge[number] = token.startswith(_SPACE) if self.lead else token.endswith(_WORD_END)
        self.line = words.get(_LINE, -1)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.endings: dict[str, bytes] = {}

    def _words(self, texts: Sequence[str]) -> pa.ListArray:
        """Keys of the parts where white space is dropped: words between spaces and lines."""
        return pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")

    def _parts(self, text: str) -> list[str]:
        """Keys of the parts where spaces lead. The first is the text's beginning as it
        stands; any other stands for a space and the word, unless it begins with a line feed."""
        if " ".join(text.split()) == text.replace("\n", " "):
            return text.replace("\n", " \n").split(" ")
        return _LEADING.split(text)

    def _ids(self, sources: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(sources, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _learn(self, keys: list[str]) -> None:
        """Ids of new keys. The punctuation that ends a word is encoded apart from it, as
        the pre-tokenizers part them behind a letter or digit."""
        young, old = self.young, self.old.get
        ended, unknown = [], set()
        for key in keys:
            ids = old(key)
            if ids is not None:
                young[key] = ids
                continue
            word = key.rstrip(_ENDINGS)
            if word is key or not word:
                unknown.add(key)
                continue
            last = word[-1]
            if not (last if last.isascii() else _normal(last)[-1]).isalnum():
                unknown.add(key)
                continue
            ended.append((key, word))
            if word not in young:
                ids = old(word)
                if ids is None:
                    unknown.add(word)
                else:
                    young[word] = ids
        self._encode_words(unknown)
        endings = self.endings
        for key, word in ended:
            ending = key[len(word) :]
            if ending not in endings:
                if len(endings) > self.kept:
                    endings.clear()
                endings[ending] = self._ids([ending])[0]
            young[key] = young[word] + endings[ending]

    def _encode_words(self, keys: set[str]) -> None:
        """Encode many words of letters as one text, and part its ids again where a word
        ends or a space or line feed leads. Other keys go alone, and so do those of a group
        that has another number of such places."""
        plain, lines, others = [], [], []
        for key in keys:
            if key[:1] == "\n":
                (lines if self.lead and key[1:].isalpha() else others).append(key)
            elif key.isalpha() and (self.lead or key.isascii() or _normal(key).isalpha()):
                plain.append(key)
            else:
                others.append(key)
        for own, joint in ((plain, " "), (lines, "")):
            groups = [own[i : i + _JOINED] for i in range(0, len(own), _JOINED)]
            texts = [joint + joint.join(g) for g in groups]
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for group, encoding in zip(groups, encoded):
                ids = np.array(encoding.ids, "<u4")
                places = np.flatnonzero(self.edge[ids] if joint else ids == self.line)
                if len(places) != len(group):
                    others += group
                    continue
                if self.lead:
                    cuts = np.append(places, len(ids)) * 4
                else:
                    cuts = np.insert(places + 1, 0, 0) * 4
                data, cuts = ids.tobytes(), cuts.tolist()
                for key, low, high in zip(group, cuts, cuts[1:]):
                    self.young[key] = data[low:high]
        sources = [" " + k if self.lead and k[:1] != "\n" else k for k in others]
        self.young.update(zip(others, self._ids(sources)))

    def _known(self, keys: list[str]) -> list[bytes]:
        """Ids of unique keys."""
        if len(self.young) > self.kept:
            self.old, self.young = self.young, {}
        young = self.young
        missing = [key for key in keys if key not in young]
        if missing:
            self._learn(missing)
        return [young[key] for key in keys]

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text; a null text is an empty one."""
        whole = {i: t for i, t in enumerate(texts) if t and any(n in t for n in self.names)}
        cut = ["" if i in whole else t or "" for i, t in enumerate(texts)]
        firsts: list[bytes] = [b""] * len(cut)
        if self.lead:
            parts = [self._parts(t) for t in cut]
            firsts = self._ids([own[0] for own in parts])
            words = pa.array([key for own in parts for key in own[1:]], pa.string())
            bounds = np.cumsum([0, *(len(own) - 1 for own in parts)])
        else:
            lists = self._words(cut)
            words, bounds = lists.values, lists.offsets.to_numpy()
        whole = dict(zip(whole, self._ids(list(whole.values()))))
        flat = words.dictionary_encode()
        coded = self._known(flat.dictionary.to_pylist())
        lengths = np.array([len(x) for x in coded], np.int64) // 4
        tokens = np.frombuffer(b"".join(coded), "<u4")
        at = flat.indices.to_numpy()
        counts = lengths[at]
        ends = np.cumsum(counts)
        shift = (np.cumsum(lengths) - lengths)[at] - (ends - counts)
        data = tokens[np.repeat(shift, counts) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
        cuts = (np.append(0, ends)[bounds] * 4).tolist()
        return [
            whole[i] if i in whole else firsts[i] + data[low:high]
            for i, (low, high) in enumerate(zip(cuts, cuts[1:]))
        ]


_encoders: dict[tuple, WordEncoder] = {}


def encoder(path: str, spaces: str, kept: int = KEPT_WORDS) -> WordEncoder:
    """One encoder per vocabulary and worker process, kept from task to task."""
    key = (path, spaces, kept)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, spaces, kept)
    return _encoders[key]


def slices(lengths: Sequence[int], most: int = 4_000_000) -> list[tuple[int, int]]:
    """Ranges of rows with about ``most`` characters in all, at least one row each."""
    out, low, total = [], 0, 0
    for i, length in enumerate(lengths):
        if total and total + length > most:
            out.append((low, i))
            low, total = i, 0
        total += length or 1
    if low < len(lengths):
        out.append((low, len(lengths)))
    return out
