"""District rules as data.

Every literal the calculation depends on sits in :class:`Rules`; another
district passes its own instance instead of changing code.  Subjects compare
without regard to letter case, so rule subjects are exposed as upper-case keys.
"""

from __future__ import annotations

from dataclasses import dataclass

MULTI_MATCH = ("sum", "min", "error")
CURRENT_MATCH = ("min", "error", "set_aside")
DUPLICATE_SEED = ("keep", "max", "error", "set_aside")
COHORT_MATCH = ("contains", "token")


def key(subject: str) -> str:
    return subject.upper()


def keys(subjects: tuple[str, ...]) -> list[str]:
    return [key(s) for s in subjects]


@dataclass(frozen=True)
class Rules:
    # Spelling and numbers are part of the expected results.
    credits_per_semester: int = 5
    full_semester: int = 8
    seed_excluded: tuple[str, ...] = ("Total",)
    total_subjects: tuple[str, ...] = ("Total", "T")
    any_grade_subjects: tuple[str, ...] = (
        "ALGEBRA I",
        "FOREIGN LANGUANGE",
        "WORLD HISTORY",
        "MATHEMATICS",
        "WLD Lang/V&P ARTS/CTE",
    )
    donor: str = "ALGEBRA II"
    receiver: str = "ALGEBRA I"
    remainder: str = "MATHEMATICS"
    group_members: tuple[str, ...] = ("Biological Science", "Physical Science")
    group_subject: str = "General Science"
    sink: str = "Electives"
    dual_separator: str = "|"

    # How to settle what the data leaves open.  "error" fails the run; "set_aside" grades all
    # students but those concerned, who are listed instead.
    multi_match: str = "sum"  # several source rows for one group-subject row
    current_match: str = "min"  # several current requirements for one ledger row
    duplicate_seed: str = "keep"  # one subject, two full requirements
    cohort_match: str = "contains"  # how a cohort text names a year
    rtrim_subjects: bool = False  # subjects are equal whatever spaces follow them

    def __post_init__(self) -> None:
        for name, allowed in (
            ("multi_match", MULTI_MATCH),
            ("current_match", CURRENT_MATCH),
            ("duplicate_seed", DUPLICATE_SEED),
            ("cohort_match", COHORT_MATCH),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")


DEFAULT_RULES = Rules()
