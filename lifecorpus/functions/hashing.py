"""Example digests (T15) and stable split buckets."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**32 mod 1000, for reducing a 128-bit md5 integer word by word.
_TWO32_MOD_1000 = 296


def md5_mod_1000(key: Column) -> Column:
    """int(md5(key).hexdigest(), 16) % 1000 without 128-bit arithmetic: Horner
    over the four 32-bit words of the digest, reduced at every step."""
    h = F.md5(key)
    acc = F.lit(0).cast("long")
    for i in range(4):
        word = F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("long")
        acc = (acc * _TWO32_MOD_1000 + word) % 1000
    return acc.cast("int")


def messages_text(messages: Column, start: int = 1) -> Column:
    """Injective, engine-neutral encoding of chat messages from position
    ``start`` (1-based): role, content length and content per message."""
    tail = F.slice(messages, start, F.greatest(F.size(messages) - start + 1, F.lit(0)))
    return F.array_join(F.transform(
        tail, lambda m: F.concat(m["role"], F.lit(":"), F.length(m["content"]).cast("string"),
                                 F.lit(":"), m["content"])), "")


def example_digest(messages: Column) -> Column:
    """sha1 over every message except the system prompt."""
    return F.sha1(F.encode(messages_text(messages, 2), "UTF-8"))
