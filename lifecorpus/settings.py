"""Owner identity and build limits (driver-side settings, no data work)."""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    name: str
    emails: tuple[str, ...] = ()
    names: tuple[str, ...] = ()
    skip_senders: tuple[str, ...] = ()
    min_chars: int = 2
    context_messages: int = 12
    max_chars_per_example: int = 6000
    max_doc_chars: int | None = None  # None: whole documents
    max_lifelog_items: int | None = None  # None: all items of a day

    @staticmethod
    def make(name: str, emails=(), names=(), skip_senders=(), **kw) -> "Settings":
        """Lower-case identities as the reference's loader does; the owner's name is
        always one of the names."""
        em = tuple(sorted({e.lower() for e in emails}))
        nm = tuple(sorted({n.lower() for n in names} | {name.lower()}))
        sk = tuple(s.lower() for s in skip_senders)
        return Settings(name=name, emails=em, names=nm, skip_senders=sk, **kw)

    @property
    def max_turns(self) -> int:
        return 2 * self.context_messages
