"""The two readings of the quality rules, as one switch.

``documented`` follows the stated intent: a JSON null id counts as missing and
money keeps its cents.  ``literal`` follows the letter of the rules: a JSON
null id is a present value, and money is parsed as a whole number (halves away
from zero) before it lands in its two-decimal column.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    name: str
    null_id_is_missing: bool
    money_scale: int


DOCUMENTED = Profile("documented", null_id_is_missing=True, money_scale=2)
LITERAL = Profile("literal", null_id_is_missing=False, money_scale=0)

_BY_NAME = {p.name: p for p in (DOCUMENTED, LITERAL)}


def resolve_profile(profile: str | Profile) -> Profile:
    if isinstance(profile, Profile):
        return profile
    if profile not in _BY_NAME:
        raise ValueError(f"profile must be one of {sorted(_BY_NAME)}, not {profile!r}")
    return _BY_NAME[profile]
