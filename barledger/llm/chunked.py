"""Token ids of whole texts by the tokenizer's own library, each distinct chunk encoded once.

A byte-level BPE without normalizer never joins a space and what follows it to what stands
before, so a text may be cut before every space that a non-space follows: each chunk alone
gives the ids that it gives inside the text.  A worker remembers chunks (bounded) and hands only
new ones to the library.  Texts that hold NUL or a string of an added token, and tokenizers of another
build, are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Chunks remembered by a Python worker; beyond it, it starts anew.
MEMO_CHUNKS = 700_000
_CUT = re.compile(r" (?=\S)")
_ODD_SPACE = re.compile(r" \s")


class Chunked:
    def __init__(self, path: str):
        self.memo: dict[str, bytes] = {}
        self.piece = None
        if path.endswith(".model"):
            import sentencepiece

            self.piece = sentencepiece.SentencePieceProcessor(model_file=path)
            self.cuttable = False
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        before = said.get("pre_tokenizer") or {}
        self.cuttable = (
            not said.get("normalizer")
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not said.get("post_processor")
        )
        self.added = [t["content"] for t in said.get("added_tokens") or ()]

    def _library(self, texts: list[str]) -> list[list[int]]:
        if self.piece is not None:
            return self.piece.encode(texts, num_threads=1)
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not self.cuttable:
            return [np.array(i, np.uint32).tobytes() for i in self._library(texts)]
        if len(self.memo) > MEMO_CHUNKS:
            self.memo = {}
        chunks: list[list[str] | None] = []
        new: set[str] = set()
        for t in texts:
            if "\0" in t or any(a in t for a in self.added):
                chunks.append(None)
                continue
            c = _CUT.split(t) if _ODD_SPACE.search(t) else t.split(" ")
            # inside the memo a chunk stands without its space; the first chunk, which has none, behind NUL
            c[0] = "\0" + c[0]
            chunks.append(c)
            new.update(c)
        new.difference_update(self.memo)
        order = list(new)
        for i in range(0, len(order), 20_000):
            part = order[i : i + 20_000]
            whole = [x[1:] if x[:1] == "\0" else " " + x for x in part]
            for x, ids in zip(part, self._library(whole)):
                self.memo[x] = np.array(ids, np.uint32).tobytes()
        get = self.memo.__getitem__
        out = []
        for t, c in zip(texts, chunks):
            out.append(np.array(self._library([t])[0], np.uint32).tobytes() if c is None else b"".join(map(get, c)))
        return out


_LOADED: dict[str, Chunked] = {}


def tokenizer(path: str) -> Chunked:
    if path not in _LOADED:
        _LOADED[path] = Chunked(path)
    return _LOADED[path]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
