"""Rules for direct identifiers inside free text.

Patterns avoid look-around and back-references so Java's regex engine and
RE2 (the oracle's) find the same leftmost-first, non-overlapping matches.
Order matters: the most specific rule runs first, because a phone pattern
would otherwise eat a card number, and later rules see earlier masks.

``guard`` is a plain substring every match contains; texts without it skip
the regex (a match is impossible there), which saves the scan of the
backtracking-heavy rules on most texts.

``before`` and ``after`` say what must not stand next to a match (patterns of one or
two characters): a card number is no part of a longer run of digits, an address no
part of a longer dotted number. Java looks around for them (``engine_pattern``).

``java`` is the same rule for Java's engine, where it needs to say that a
match only starts where a run starts (or where the last match ended) and never
gives characters back: time then grows with the text, not with its square.
No rule repeats a group, so none recurses.
"""

from __future__ import annotations

from typing import NamedTuple


class TextRule(NamedTuple):
    kind: str
    pattern: str
    mask: str
    guard: str | None = None
    java: str | None = None
    before: str | None = None
    after: str | None = None

    @property
    def engine_pattern(self) -> str:
        """The rule as Spark runs it."""
        if self.java is not None:
            return self.java
        return (f"(?<!{self.before})" if self.before else "") + f"(?:{self.pattern})" + (f"(?!{self.after})" if self.after else "")


# Fixed rule set, applied in this order.
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Sixteen digits in fours or in one run, and the shapes of issuers with 13, 14, 15 or 19 digits.
CARD = TextRule("card", r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}"
                        r"|3(0[0-5]|[68][0-9])[0-9][ -]?[0-9]{6}[ -]?[0-9]{4}|4[0-9]{18}|4[0-9]{12}", "[CARD]",
                before="[0-9]", after="[0-9]")
# International numbers (+ and country), and national ones: an area code in
# brackets, or beginning with 0 and set off from the number.
PHONE = TextRule("phone", r"(\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?|\(0?[0-9]{2,4}\)|0[0-9]{1,3}[ ./-])"
                          r"[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}", "[PHONE]")
IPV4 = TextRule("ip", rf"{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}", "[IP]", ".",
                before=r"[0-9.]", after=r"[0-9]|\.[0-9]")
EMAIL = TextRule("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]", "@",
                 r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")

DEFAULT_RULES: tuple[TextRule, ...] = (CARD, PHONE, IPV4, EMAIL)
