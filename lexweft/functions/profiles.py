"""Language profiles: what the text functions fold, drop and take for a word.

A profile is data. Queries name one; all functions work under any of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Profile:
    name: str
    marks: str  # characters dropped by norm (a regex class's inside)
    fold_from: str
    fold_to: str  # as long as fold_from or shorter: characters without a partner are dropped
    letters: str  # a regex class's inside: what a word of `words` consists of
    proclitics: tuple[tuple[str, ...], ...] = ()  # groups; of each, one may be taken off a word's front
    final: str = ""  # a last character that stem drops from words of four and more
    same: dict[str, str] = field(default_factory=dict)  # stems taken for one
    stop: frozenset[str] = frozenset()

    def norm(self, text: str | None) -> str:
        """One text (a query) as functions.text.norm gives it."""
        marks = re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: chr(int(m[1], 16)), self.marks)
        fold = {ord(a): b for a, b in zip(self.fold_from, self.fold_to, strict=False)} | {ord(a): None for a in self.fold_from[len(self.fold_to) :]}
        return re.sub(f"[{marks}]", "", text or "").lower().translate(fold)

    def tokens(self, text: str | None) -> list[str]:
        """One text as functions.text.tokens gives it."""
        return re.findall(r"[^\W_]+", self.norm(text))

    def clean(self, text: str | None) -> str:
        """One text as functions.text.clean gives it."""
        return " ".join(re.findall(r"[^\W\d_]+", self.norm(text)))


# Vowel marks, Quranic marks, tatweel and private-use characters.
ARABIC_MARKS = r"\x{0610}-\x{061A}\x{064B}-\x{065F}\x{0670}\x{06D6}-\x{06ED}\x{0640}\x{E000}-\x{F8FF}"
# Spelling variants and digits, each with what it becomes; joiners and direction marks become nothing.
ARABIC_FOLD_FROM = "أإآٱٲٳىیېۍکڪةۀەھۃؤئ" + "٠١٢٣٤٥٦٧٨٩" + "۰۱۲۳۴۵۶۷۸۹" + "‌‍‎‏﻿"
ARABIC_FOLD_TO = "اااااا" + "يييي" + "كك" + "ههههه" + "و" + "ي" + "0123456789" + "0123456789"
ARABIC_LETTERS = "ء-غف-يٱ-ۓپچژگکی"

ARABIC = Profile(
    "arabic", ARABIC_MARKS, ARABIC_FOLD_FROM, ARABIC_FOLD_TO, ARABIC_LETTERS,
    (("و", "ف"), ("ب", "ل"), ("ال", "ل")), "ا", {"ابن": "بن"},
    # Words too common to tell one quotation from another.
    frozenset("من في علي عن ان الا ما لا الي هو هي هذا هذه ذلك التي الذي قال قالت يقول رسول الله صلي عليه وسلم النبي او ثم قد لم لن اذا اذ كان كانت يا ايها له لها به بها فيه فيها منه منها عنه رضي تعالي عز وجل حتي بين كل انه انها لي لك لكم لهم هم انا انت نحن اني اي ولا وما حدثنا اخبرنا".split()),
)
PERSIAN = Profile("persian", ARABIC_MARKS, ARABIC_FOLD_FROM, ARABIC_FOLD_TO, ARABIC_LETTERS, (), "", {}, frozenset("و در به از که را این آن با است تا بر چون هم می".split()))
LATIN = Profile(
    "latin", r"\x{0300}-\x{036F}\x{00AD}", "àáâãäåçèéêëìíîïñòóôõöùúûüýÿß‌‍‎‏﻿", "aaaaaaceeeeiiiinooooouuuuyys", r"\p{L}",
    (("un", "re"),), "s", {"dont": "do"},
    frozenset("the of and to in is that it for as was with be by on not he at from a der die und das den von zu mit für sich des ist nicht ein auf dem im le la les de des et un une du en que pour est dans qui par sur au plus el los y del las se por con para como al lo su no más".split()),
)
PROFILES = {p.name: p for p in (ARABIC, PERSIAN, LATIN)}
