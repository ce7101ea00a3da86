"""Token ids of texts with a public byte-level BPE vocabulary, inside Python workers."""

from __future__ import annotations

import array
import base64
import functools
import os
import re
from collections.abc import Callable

# Characters on which both libraries' notions of letter, digit and white space agree for
# certain: printable ASCII, line ends, and the Latin letters and signs up to U+024F.
FAMILIAR = re.compile("[^\t\n\r\x20-\x7e¡-¬®-ɏ]")


@functools.lru_cache(maxsize=2)
def byte_bpe(vocabulary: str, ranks: str, pattern: str) -> Callable[[str], array.array]:
    """A function from a text to its ids.

    ``vocabulary`` is a file of the ``tokenizers`` library and defines the ids. ``ranks``
    holds the same vocabulary for ``tiktoken``, which is several times as fast; it is used
    for texts of familiar characters without special tokens, where both agree.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(vocabulary)
    special = [t.content for t in reference.get_added_tokens_decoder().values()]
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> array.array:
        if FAMILIAR.search(text) or any(s in text for s in special):
            return array.array("I", reference.encode(text, add_special_tokens=False).ids)
        return array.array("I", fast.encode_ordinary(text))

    return encode
