"""Token ids of whole texts by a public tokenizer file, inside tasks."""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np

# Runs of white space from this length on don't go through the pattern, which would go back over them step by step.
LONG_WHITE = 1_000
# Fixed value: the characters that the pattern's white space stands for.
_WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_WHITE = re.compile(_WHITE + "{%d,}" % LONG_WHITE)


class ByteLevelIds:
    """Ids of a byte-level BPE file, as ``tokenizers`` gives them.

    The merges run in ``tiktoken`` with the ranks read from the same file, whose
    ids are in merge order (checked), which gives the same ids several times as
    fast. Whole texts go through it, so a worker remembers nothing between them.
    """

    def __init__(self, spec: dict):
        import tiktoken

        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        bpe = tiktoken.Encoding(
            "file", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens=special,
        )
        # One piece whatever it holds: for white space that is merged without the pattern.
        white = tiktoken.Encoding("white", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.bpe, self.white, self.special = bpe, white.encode_ordinary, special
        self.specials = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids; specials inside a text are their own ids, the library's default."""
        if len(text) < LONG_WHITE or not _LONG_WHITE.search(text):
            return self.bpe.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        return np.array(self._cut_at_runs(text), "<u4").tobytes()

    def _cut_at_runs(self, text: str) -> list[int]:
        """Ids of a text with long runs of white space, which are cut out where the pattern cuts.

        A run is one piece but for its last character, which goes on to what
        follows; at the end of a stretch between specials the whole run is one
        piece.
        """
        found: list[int] = []
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                found.append(self.special[part])
                continue
            at = 0
            for run in _LONG_WHITE.finditer(part):
                end = run.end() - (run.end() < len(part))
                found += self.bpe.encode_ordinary(part[at:run.start()]) + self.white(part[run.start():end])
                at = end
            found += self.bpe.encode_ordinary(part[at:])
        return found


class LibraryIds:
    """Ids by the library that the file is for: ``tokenizers`` for .json, ``sentencepiece`` for .model."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda text: model.encode(text, num_threads=1)
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_padding()
            model.no_truncation()
            self.encode = lambda text: model.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()


# Fixed value: the pattern byte-level files cut text by before merging.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOADED: dict[str, ByteLevelIds | LibraryIds] = {}


def _byte_letters() -> dict[str, int]:
    """The printable letter a byte-level vocabulary writes for each byte, to the byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(others)}}


def _is_plain_byte_level(spec: dict) -> bool:
    """Whether ranks alone describe the file: byte level, no other steps, ids in merge order, only special added tokens."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return False
    if model.get("type") != "BPE" or any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges",
    )):
        return False
    if any(not t["special"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        return False
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    made = [model["vocab"]["".join(p)] for p in pairs]
    return all(x < y for x, y in zip(made, made[1:]))


def load(path: str) -> ByteLevelIds | LibraryIds:
    """The encoder of a tokenizer file, once per worker process."""
    if path not in _LOADED:
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            _LOADED[path] = ByteLevelIds(spec) if _is_plain_byte_level(spec) else LibraryIds(path)
        else:
            _LOADED[path] = LibraryIds(path)
    return _LOADED[path]


def version(path: str) -> str:
    """Digest of the file's content: other files never share cached counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
