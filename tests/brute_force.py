"""The rules, one student at a time, in plain Python: a second opinion for small data."""

from __future__ import annotations

from collections import defaultdict
from math import floor

SCIENCE = {"BIOLOGICAL SCIENCE", "PHYSICAL SCIENCE"}
GROUP, SINK = "GENERAL SCIENCE", "ELECTIVES"
ANY_GRADE = {
    "ALGEBRA I",
    "FOREIGN LANGUANGE",
    "WORLD HISTORY",
    "MATHEMATICS",
    "WLD LANG/V&P ARTS/CTE",
}


def semesters(amounts) -> int:
    return floor(sum(a for a in amounts if a is not None) / 5)


def grade_student(grades, reqs, courses, year, mid_year):
    """``courses``: (subject, taken_in, term, mark, earned, attempted).

    Returns the ledger {key: row}, the dual courses {key: row} and the codes.
    """
    ledger = {}
    for grade in grades:
        for cohort, semester, subject, reqd, _ in reqs:
            if semester == 8 and subject.upper() != "TOTAL" and grade is not None:
                if cohort is not None and str(year + 12 - grade) in cohort:
                    ledger[subject.upper()] = {"R": reqd, "sem": -1, "need": 0, "close": 0}
    if not ledger:
        return {}, {}, None
    found = defaultdict(list)
    for grade in grades:
        dated = grade is not None and 9 <= grade <= 12
        for cohort, semester, subject, reqd, close in reqs:
            if dated:
                hit = semester == 2 * grade - 17 + mid_year and str(year + 12 - grade) in (cohort or "")
            else:
                hit = semester == 1
            if hit:
                found[subject.upper()].append((semester, reqd, close))
    for k, row in ledger.items():
        if k in found:
            row["sem"], row["need"], row["close"] = min(found[k])

    done, open_, all_done, all_open = (defaultdict(list) for _ in range(4))
    passed = defaultdict(list)
    for subject, taken_in, term, mark, earned, attempted in courses:
        if subject is None:
            continue
        k = subject.upper()
        late = taken_in is not None and (taken_in > 8 or (taken_in == 8 and term == 3))
        if k in ANY_GRADE or late:
            (open_ if mark is None else done)[k].append(attempted if mark is None else earned)
        (all_open if mark is None else all_done)[k].append(attempted if mark is None else earned)
        passed[k].append(earned if mark is not None and mark > 0 else 0)
    for k, row in ledger.items():
        row["c"], row["i"] = semesters(done[k]), semesters(open_[k])

    give_c, give_i = semesters(all_done["ALGEBRA II"]), semesters(all_open["ALGEBRA II"])
    if "ALGEBRA I" in ledger:
        row = ledger["ALGEBRA I"]
        moved = min(max(row["R"] - row["c"] - row["i"], 0), give_c)
        row["c"] += moved
        give_c -= moved
        moved = min(max(row["R"] - row["c"] - row["i"], 0), give_i)
        row["i"] += moved
        give_i -= moved
    if "MATHEMATICS" in ledger:
        ledger["MATHEMATICS"]["c"] += give_c
        ledger["MATHEMATICS"]["i"] += give_i

    if GROUP in ledger:
        for k in SCIENCE & set(ledger):
            row = ledger[k]
            extra = max(row["c"] + row["i"] - row["R"], 0)
            from_open = min(row["i"], extra)
            for part, amount in (("i", from_open), ("c", extra - from_open)):
                row[part] -= amount
                ledger[GROUP][part] += amount

    spill(ledger)
    duals = {}
    for k in [k for k in passed if "|" in k]:
        duals[k] = split_dual(ledger, k, semesters(passed[k]), semesters(all_open[k]))
    for row in duals.values():
        for target, part in ((row["p"], "p"), (row["s"], "s"), (GROUP, "g"), (SINK, "o")):
            if target in ledger:
                ledger[target]["c"] += row[part + "C"]
                ledger[target]["i"] += row[part + "I"]
    spill(ledger)

    for row in ledger.values():
        have = row["c"] + row["i"]
        row["code"] = 2 if have >= row["need"] else 1 if have >= row["close"] else 0
    semester = max(row["sem"] for row in ledger.values())
    have = sum(row["c"] + row["i"] for row in ledger.values())
    grad_year = str(year + 4 - -(-semester // 2))
    totals = [
        2 if have >= reqd else 1 if have >= close else 0
        for cohort, sem, subject, reqd, close in reqs
        if sem == semester and subject.upper() in ("TOTAL", "T") and grad_year in (cohort or "")
    ]
    worst = min(row["code"] for row in ledger.values())
    final = min(min(totals), worst) if totals else None
    return ledger, duals, final


def spill(ledger) -> None:
    got_c = got_i = 0
    for k, row in ledger.items():
        if k != SINK and row["c"] + row["i"] > row["R"]:
            over_c = max(row["c"] - row["R"], 0)
            over_i = max(row["i"] - max(row["R"] - row["c"], 0), 0)
            row["c"] -= over_c
            row["i"] -= over_i
            got_c += over_c
            got_i += over_i
    if SINK in ledger:
        ledger[SINK]["c"] += got_c
        ledger[SINK]["i"] += got_i


def fill(have_c, have_i, need, top_up):
    if need is None or need <= 0:
        return 0, 0
    if have_c >= need:
        return need, 0
    return have_c, top_up if have_c + have_i >= need else have_i


def split_dual(ledger, k, have_c, have_i):
    p, s = k.split("|", 1)

    def need(subject):
        row = ledger.get(subject)
        return None if row is None else row["R"] - row["c"] - row["i"]

    n = need(p)
    p_c, p_i = fill(have_c, have_i, n, None if n is None else n - have_c)
    g_c = g_i = s_c = s_i = 0
    if p in SCIENCE:
        if GROUP in ledger:
            g_c, g_i = fill(have_c - p_c, have_i - p_i, n, n)
    else:
        s_c, s_i = fill(have_c - p_c, have_i - p_i, need(s), need(s))
    if s in SCIENCE and GROUP in ledger and p in ledger:
        extra = max(have_c + have_i - ledger[p]["R"], 0)
        x_i = min(have_i, extra)
        x_c = extra - x_i
        g_c, g_i, have_c, have_i = g_c + x_c, g_i + x_i, have_c - x_c, have_i - x_i
    return {
        "p": p, "s": s, "C": have_c, "I": have_i,
        "pC": p_c, "pI": p_i, "sC": s_c, "sI": s_i, "gC": g_c, "gI": g_i,
        "oC": have_c - p_c - s_c - g_c, "oI": have_i - p_i - s_i - g_i,
    }
