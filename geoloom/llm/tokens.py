"""Token ids of whole texts with a public tokenizer's files.

The ids are those that ``tokenizers`` gives for the JSON file with
``add_special_tokens=False``.  Words repeat, so each distinct word is encoded once per
task by the merge ranks of the same vocabulary and its ids are joined from a cache; this
is sound because the vocabulary's split never joins a word with what stands before a
single space.  Texts with other runs of spaces are encoded whole, texts that spell a
special token go through ``tokenizers`` itself.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
CACHED_WORDS = 300_000


def vocabulary_size(json_path: str = BYTE_BPE) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path).get_vocab_size()


def encoder(json_path: str = BYTE_BPE) -> Callable[[str | None], bytes]:
    """A function from text (null: empty) to its ids as little-endian uint32."""
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    with open(json_path.removesuffix(".json") + ".tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    uneven = re.compile(r"^ | \s|\s | $").search
    words: dict[str, bytes] = {}

    def ids_of(text: str) -> bytes:
        return array("I", fast.encode_ordinary(text)).tobytes()

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in special):
            return array("I", exact.encode(text, add_special_tokens=False).ids).tobytes()
        if uneven(text):
            return ids_of(text)
        first, *rest = text.split(" ")
        out = [ids_of(first)]
        get = words.get
        for w in rest:
            ids = get(w)
            if ids is None:
                ids = ids_of(" " + w)
                if len(words) >= CACHED_WORDS:
                    words.clear()
                if len(w) <= 64:
                    words[w] = ids
            out.append(ids)
        return b"".join(out)

    return encode
