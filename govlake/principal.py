"""Who is asking: a name and the groups it belongs to."""

from __future__ import annotations

from dataclasses import dataclass, field

from govlake.design import ALL_USERS, OWNERS


class AccessDenied(PermissionError):
    """The principal lacks a privilege; the message names the highest missing level."""


@dataclass(frozen=True)
class Principal:
    name: str
    groups: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def of(cls, name: str, *groups: str) -> "Principal":
        return cls(name, frozenset(groups))

    def holds(self, group: str) -> bool:
        return group == ALL_USERS or group in self.groups

    @property
    def grantees(self) -> frozenset[str]:
        """Every name a grant to which reaches this principal."""
        return self.groups | {self.name, ALL_USERS}


def require_exempt(principal: Principal, exempt_group: str = OWNERS) -> None:
    """Refuse to build tables as a masked identity, which would store masked values for good."""
    if not principal.holds(exempt_group):
        raise AccessDenied(
            f"{principal.name} is not in {exempt_group}: a build run by a masked identity "
            "would store masked values")
