"""The expected result of every query, as DuckDB SQL over the given tables.

Written directly from the rules, with joins and grouped subqueries where the
Spark plans use windows, maps and precomputed lookups.  Each step is a CTE; a
query selects from one of them.
"""

from __future__ import annotations

from creditledger.sources.derived import COHORTS, COURSES, MID_YEAR, SHORT_TOTAL_COHORT, YEAR


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_COURSE = " ".join(f"when {n} then {_quoted(c)}" for n, c in enumerate(COURSES))
_FULL = ", ".join(
    f"({_quoted(cohort)}, {_quoted(subject)}, {due})"
    for cohort, subjects in COHORTS.items()
    for subject, due in subjects.items()
)
_ANY_GRADE = "('ALGEBRA I','FOREIGN LANGUANGE','WORLD HISTORY','MATHEMATICS','WLD LANG/V&P ARTS/CTE')"
_SCIENCE = "('BIOLOGICAL SCIENCE','PHYSICAL SCIENCE')"


def _steps(year: int, mid_year: int) -> list[tuple[str, str]]:
    return [
        # --- input tables
        ("student", "select c_custkey as sid, cast(6 + c_custkey % 8 as int) as grade from customer"),
        (
            "status_before",
            "select c_custkey as sid, 'unknown' as gs from customer",
        ),
        (
            "course",
            f"""select o.o_custkey as sid, case cast(l.l_partkey % 16 as int) {_COURSE} end as subject,
              cast(8 + l.l_suppkey % 5 as int) as taken_in, cast(1 + l.l_linenumber % 3 as int) as term,
              case when l.l_returnflag = 'N' and l.l_linestatus = 'O' then null
                   else cast(floor(l.l_quantity) as int) % 5 end as mark,
              case when cast(floor(l.l_quantity) as int) % 10 = 0 then 0.0
                   when cast(floor(l.l_quantity) as int) % 7 = 0 then 2.5 else 5.0 end as earned,
              5.0 as tried, upper(subject) as k
            from lineitem l join orders o on o.o_orderkey = l.l_orderkey""",
        ),
        (
            "req",
            f"""with f as (select *, unnest([1,2,3,4,5,6,7,8]) as semester
                from (values {_FULL}) v(cohort, subject, due)),
              r as (select cohort, semester, subject, cast(ceil(due * semester / 8.0) as int) as reqd, 1 as slack
                    from f
                    union all
                    select cohort, semester,
                      case when cohort = {_quoted(SHORT_TOTAL_COHORT)} and semester < 8 then 'T' else 'Total' end,
                      cast(ceil(sum(due) * semester / 8.0) as int), 3
                    from f group by cohort, semester)
            select cohort, semester, subject, upper(subject) as k, reqd, greatest(reqd - slack, 0) as close_at
            from r""",
        ),
        # --- requirements
        (
            "seed",
            f"""select st.sid, r.k, min(r.subject) as subject, r.reqd as total
            from student st join req r on contains(r.cohort, cast({year} + 12 - st.grade as varchar))
            where r.semester = 8 and r.k <> 'TOTAL' group by st.sid, r.k, r.reqd""",
        ),
        (
            "by_grade",
            f"""select st.sid, r.semester, r.subject, r.k, r.reqd, r.close_at
            from student st join req r
              on st.grade in (9, 10, 11, 12) and r.semester = 2 * st.grade - 17 + {mid_year}
                 and contains(r.cohort, cast({year} + 12 - st.grade as varchar))
            union all
            select st.sid, r.semester, r.subject, r.k, r.reqd, r.close_at
            from student st join req r on (st.grade < 9 or st.grade > 12) and r.semester = 1""",
        ),
        (
            "required",
            """select s.*, coalesce(b.semester, -1) as semester, coalesce(b.reqd, 0) as reqd,
              coalesce(b.close_at, 0) as close_at
            from seed s left join (select * from by_grade qualify
              row_number() over (partition by sid, k order by semester, reqd, close_at) = 1) b using (sid, k)""",
        ),
        (
            "required_twice",
            f"""select s.*, coalesce(b.semester, -1) as semester, coalesce(b.reqd, 0) as reqd,
              coalesce(b.close_at, 0) as close_at
            from (select distinct st.sid, r.k, min(r.subject) over (partition by st.sid, r.k) as subject, r.reqd as total
                  from student st join (select cohort, semester, subject, k, reqd from req
                    union all select '2024,2025', 8, 'english', 'ENGLISH', 6) r
                    on contains(r.cohort, cast({year} + 12 - st.grade as varchar))
                  where r.semester = 8 and r.k <> 'TOTAL') s
            left join (select * from by_grade qualify
              row_number() over (partition by sid, k order by semester, reqd, close_at) = 1) b using (sid, k)""",
        ),
        # --- transcript
        (
            "hs",
            f"""select sid, k, min(subject) as subject,
              cast(floor(coalesce(sum(earned) filter (where mark is not null), 0) / 5) as bigint) as c,
              cast(floor(coalesce(sum(tried) filter (where mark is null), 0) / 5) as bigint) as i
            from course where k not in {_ANY_GRADE} and (taken_in >= 9 or (taken_in = 8 and term = 3))
            group by sid, k""",
        ),
        (
            "anyg",
            f"""select sid, k, min(subject) as subject,
              cast(floor(coalesce(sum(earned) filter (where mark is not null), 0) / 5) as bigint) as c,
              cast(floor(coalesce(sum(tried) filter (where mark is null), 0) / 5) as bigint) as i
            from course where k in {_ANY_GRADE} group by sid, k""",
        ),
        ("counts", "select * from hs union all select * from anyg"),
        (
            "l1",
            """select r.*, coalesce(n.c, 0) as c, coalesce(n.i, 0) as i
            from required r left join (select sid, k, c, i from counts) n using (sid, k)""",
        ),
        # --- donor
        (
            "donor",
            """select sid,
              cast(floor(coalesce(sum(earned) filter (where mark is not null), 0) / 5) as bigint) as dc,
              cast(floor(coalesce(sum(tried) filter (where mark is null), 0) / 5) as bigint) as di
            from course where k = 'ALGEBRA II' group by sid""",
        ),
        (
            "give",
            """select d.sid, least(greatest(l.total - l.c - l.i, 0), d.dc) as tc,
              least(greatest(l.total - l.c - l.i - tc, 0), d.di) as ti, d.dc, d.di
            from donor d join l1 l on l.sid = d.sid and l.k = 'ALGEBRA I'""",
        ),
        (
            "l2",
            """select l.* replace (
                c + case k when 'ALGEBRA I' then coalesce(g.tc, 0)
                           when 'MATHEMATICS' then coalesce(d.dc - coalesce(g.tc, 0), 0) else 0 end as c,
                i + case k when 'ALGEBRA I' then coalesce(g.ti, 0)
                           when 'MATHEMATICS' then coalesce(d.di - coalesce(g.ti, 0), 0) else 0 end as i)
            from l1 l left join donor d on d.sid = l.sid left join give g on g.sid = l.sid""",
        ),
        # --- science group
        (
            "science",
            f"""select sid, k, subject, least(i, greatest(i + c - total, 0)) as si,
              greatest(i + c - total, 0) - least(i, greatest(i + c - total, 0)) as sc
            from l2 where k in {_SCIENCE} and sid in (select sid from l2 where k = 'GENERAL SCIENCE')""",
        ),
        (
            "l3",
            """select l.* replace (
                l.c - coalesce(s.sc, 0) + case when l.k = 'GENERAL SCIENCE' then coalesce(t.sc, 0) else 0 end as c,
                l.i - coalesce(s.si, 0) + case when l.k = 'GENERAL SCIENCE' then coalesce(t.si, 0) else 0 end as i)
            from l2 l left join science s on s.sid = l.sid and s.k = l.k
            left join (select sid, sum(sc) as sc, sum(si) as si from science group by sid) t on t.sid = l.sid""",
        ),
        (
            "lost",
            """select d.sid, 'donor' as kind, 'ALGEBRA II' as subject,
              d.dc - coalesce(g.tc, 0) as c, d.di - coalesce(g.ti, 0) as i
            from donor d left join give g on g.sid = d.sid
            where d.sid in (select sid from l1) and (d.dc > coalesce(g.tc, 0) or d.di > coalesce(g.ti, 0))
            union all
            select sid, 'overflow', null, sum(greatest(c - total, 0)),
              sum(greatest(i - greatest(total - c, 0), 0))
            from (select sid, k, total, c, i from l3 where k <> 'MATHEMATICS'
                  union all select sid, k, total, c, i from l1 where k = 'MATHEMATICS')
            where c + i > total group by sid""",
        ),
        # --- first overflow round
        ("over1", _overflow("l3")),
        ("l4", _spilled("l3", "over1")),
        # --- dual courses
        (
            "d0",
            """select sid, k, min(subject) as subject,
              k[: instr(k, '|') - 1] as pk, k[instr(k, '|') + 1 :] as sk,
              cast(floor(coalesce(sum(earned) filter (where mark > 0), 0) / 5) as bigint) as c,
              cast(floor(coalesce(sum(tried) filter (where mark is null), 0) / 5) as bigint) as i
            from course where contains(subject, '|') group by sid, k""",
        ),
        (
            "d1",
            """select d.*, p.total as ptotal, p.total - p.c - p.i as pn, s.total - s.c - s.i as sn,
              d.sid in (select sid from l4 where k = 'GENERAL SCIENCE') as owns,
              case when pn > 0 then least(d.c, pn) else 0 end as pc,
              case when pn > 0 then least(d.i, pn - pc) else 0 end as pi
            from d0 d left join l4 p on p.sid = d.sid and p.k = d.pk
            left join l4 s on s.sid = d.sid and s.k = d.sk""",
        ),
        (
            "d2",
            f"""select *, coalesce(pn > 0 and pk in {_SCIENCE} and owns, false) as to_group,
              case when to_group then least(c - pc, pn) else 0 end as gc,
              case when not to_group or c - pc >= pn then 0
                   when c - pc + i - pi >= pn then pn else i - pi end as gi
            from d1""",
        ),
        (
            "d3",
            f"""select *, coalesce(sn > 0 and pk not in {_SCIENCE}, false) as to_second,
              case when to_second then least(c - pc - gc, sn) else 0 end as sc,
              case when not to_second or c - pc - gc >= sn then 0
                   when c - pc - gc + i - pi - gi >= sn then sn else i - pi - gi end as si
            from d2""",
        ),
        (
            "d4",
            f"""select *, sk in {_SCIENCE} and owns and ptotal is not null as measured,
              case when measured then greatest(i + c - ptotal, 0) end as xs,
              case when measured then least(i, xs) end as xi
            from d3""",
        ),
        (
            "d5",
            """select sid, subject, pk, sk, pc, pi, sc, si,
              subject[: instr(subject, '|') - 1] as p_subject, subject[instr(subject, '|') + 1 :] as s_subject,
              gc + coalesce(xs - xi, 0) as gc, gi + coalesce(xi, 0) as gi,
              c - coalesce(xs - xi, 0) as c, i - coalesce(xi, 0) as i,
              c - 2 * coalesce(xs - xi, 0) - pc - sc - d4.gc as oc,
              i - 2 * coalesce(xi, 0) - pi - si - d4.gi as oi
            from d4""",
        ),
        (
            "posts",
            """select sid, k, sum(ac) as ac, sum(ai) as ai from (
              select sid, pk as k, pc as ac, pi as ai from d5 union all
              select sid, sk, sc, si from d5 union all
              select sid, 'GENERAL SCIENCE', gc, gi from d5 union all
              select sid, 'ELECTIVES', oc, oi from d5)
            group by sid, k having sum(ac) <> 0 or sum(ai) <> 0""",
        ),
        (
            "l5",
            """select l.* replace (l.c + coalesce(p.ac, 0) as c, l.i + coalesce(p.ai, 0) as i)
            from l4 l left join posts p on p.sid = l.sid and p.k = l.k""",
        ),
        # --- second overflow round
        ("over2", _overflow("l5")),
        ("l6", _spilled("l5", "over2")),
        # --- status
        (
            "graded",
            "select *, case when c + i >= reqd then 2 when c + i >= close_at then 1 else 0 end as code from l6",
        ),
        ("worst_code", "select sid, min(code) as worst from graded group by sid"),
        (
            "sems_all",
            "select sid, max(semester) as semester, sum(c) as c, sum(i) as i from graded group by sid",
        ),
        (
            "total_code",
            f"""select t.sid, t.semester,
              case when t.c + t.i >= r.reqd then 2 when t.c + t.i >= r.close_at then 1 else 0 end as code
            from sems_all t join req r on r.semester = t.semester and r.k in ('TOTAL', 'T')
              and contains(r.cohort, cast({year} + 4 - cast(ceil(t.semester / 2) as int) as varchar))""",
        ),
        (
            "final",
            """select w.sid, t.semester, w.worst, t.code, least(w.worst, t.code) as code_all
            from worst_code w join total_code t on t.sid = w.sid""",
        ),
        ("final1", "select sid, min(code_all) as code_all from final group by sid"),
        # --- students set aside
        (
            "refused",
            "select sid, k, min(subject) as subject from required_twice group by sid, k having count(*) > 1",
        ),
        # --- every move of semesters
        (
            "moves",
            """select * from (
              select sid, 'donor' as rule, 'ALGEBRA II' as f, 'ALGEBRA I' as t, tc as c, ti as i,
                false as taken, true as landed from give
              union all
              select d.sid, 'donor rest', 'ALGEBRA II', 'MATHEMATICS', d.dc - coalesce(g.tc, 0),
                d.di - coalesce(g.ti, 0), false, d.sid in (select sid from l1 where k = 'MATHEMATICS')
              from donor d left join give g on g.sid = d.sid where d.sid in (select sid from l1 )
              union all
              select sid, 'group', k, 'GENERAL SCIENCE', sc, si, true, true from science
              union all
              select sid, 'overflow', k, 'ELECTIVES', oc, oi, true,
                sid in (select sid from l3 where k = 'ELECTIVES') from over1
              union all
              select sid, 'dual course', upper(subject), pk, pc, pi, false,
                (sid, pk) in (select (sid, k) from l4 ) from d5
              union all
              select sid, 'dual course', upper(subject), sk, sc, si, false,
                (sid, sk) in (select (sid, k) from l4 ) from d5
              union all
              select sid, 'dual course', upper(subject), 'GENERAL SCIENCE', gc, gi, false,
                sid in (select sid from l4 where k = 'GENERAL SCIENCE') from d5
              union all
              select sid, 'dual course', upper(subject), 'ELECTIVES', oc, oi, false,
                sid in (select sid from l4 where k = 'ELECTIVES') from d5
              union all
              select sid, 'second overflow', k, 'ELECTIVES', oc, oi, true,
                sid in (select sid from l5 where k = 'ELECTIVES') from over2 )
            where c <> 0 or i <> 0""",
        ),
    ]


def _overflow(ledger: str) -> str:
    return f"""select sid, k, subject, greatest(c - total, 0) as oc,
      greatest(i - greatest(total - c, 0), 0) as oi
    from {ledger} where k <> 'ELECTIVES' and c + i > total"""


def _spilled(ledger: str, overflow: str) -> str:
    return f"""select l.* replace (
        l.c - coalesce(o.oc, 0) + case when l.k = 'ELECTIVES' then coalesce(t.oc, 0) else 0 end as c,
        l.i - coalesce(o.oi, 0) + case when l.k = 'ELECTIVES' then coalesce(t.oi, 0) else 0 end as i)
    from {ledger} l left join {overflow} o on o.sid = l.sid and o.k = l.k
    left join (select sid, sum(oc) as oc, sum(oi) as oi from {overflow} group by sid) t on t.sid = l.sid"""


def _label(code: str) -> str:
    return f"case {code} when 2 then 'on track' when 1 then 'close' else 'off track' end"


_LEDGER = """sid as "studentID", subject, semester, c::bigint as "semsComplete", i::bigint as "semsInProgress",
  reqd::int as "semsReqdGrade", close_at::int as "semsClose", total::int as "semsReqdTotal\""""
_COUNTS = 'sid as "studentID", subject, c as "semsComp", i as "semsInp"'
_OVER = 'sid as "studentID", subject, oc::bigint as "compOverflow", oi::bigint as "inpOverflow"'
_LABEL = _label("code")

_SELECTS = {
    "seed_ledger": 'select sid as "studentID", subject, -1 as semester, total::int as "semsReqdTotal" from seed',
    "requirements_by_grade": """select sid as "studentID", semester, subject, reqd::int as "semsReqd",
      close_at::int as "semsClose" from by_grade""",
    "ledger_requirements": """select sid as "studentID", subject, semester, reqd::int as "semsReqdGrade",
      close_at::int as "semsClose", total::int as "semsReqdTotal" from required""",
    "ledger_requirements_twice": """select sid as "studentID", subject, semester, reqd::int as "semsReqdGrade",
      close_at::int as "semsClose", total::int as "semsReqdTotal" from required_twice""",
    "credits_high_school": f"select {_COUNTS} from hs",
    "credits_any_grade": f"select {_COUNTS} from anyg",
    "credits_all": f"select {_COUNTS} from counts",
    "duplicate_keys": 'select sid as "studentID", k as subject, count(*) as copies from course group by 1, 2 having count(*) > 1',
    "ledger_counts": f"select {_LEDGER} from l1",
    "donor_semesters": 'select sid as "studentID", dc as "semsComp", di as "semsInp" from donor',
    "donor_transfer": """select sid as "studentID", tc::bigint as "transferComplete", ti::bigint as "transferInProgress",
      (dc - tc)::bigint as "restComplete", (di - ti)::bigint as "restInProgress" from give""",
    "ledger_after_transfer": f"select {_LEDGER} from l2",
    "group_surplus": """select sid as "studentID", subject, sc::bigint as "surplusComplete",
      si::bigint as "surplusInProgress" from science""",
    "ledger_after_group": f"select {_LEDGER} from l3",
    "student_totals": 'select sid as "studentID", sum(c + i)::bigint as total from l3 group by sid',
    "subject_overflow": f"select {_OVER} from over1",
    "sink_posting": """select o.sid as "studentID", sum(oc)::bigint as "compOverflow", sum(oi)::bigint as "inpOverflow",
      o.sid in (select sid from l3 where k = 'ELECTIVES') as posted from over1 o group by o.sid""",
    "ledger_after_overflow": f"select {_LEDGER} from l4",
    "dual_split": """select sid as "studentID", subject, subject[: instr(subject, '|') - 1] as "primarySubj",
      subject[instr(subject, '|') + 1 :] as "secondarySubj", c as "semsComplete", i as "semsInProgress" from d0""",
    "dual_primary": """select sid as "studentID", subject, pc::bigint as "primaryComplete",
      pi::bigint as "primaryInProgress" from d1""",
    "dual_group": """select sid as "studentID", subject, gc::bigint as "semsCompleteGS",
      gi::bigint as "semsInProgressGS" from d2""",
    "dual_secondary": """select sid as "studentID", subject, sc::bigint as "secondaryComplete",
      si::bigint as "secondaryInProgress" from d3""",
    "dual_secondary_group": """select sid as "studentID", subject, (xs - xi)::bigint as "surplusComplete",
      xi::bigint as "surplusInProgress" from d4 where measured""",
    "dual_overflow": """select sid as "studentID", subject, p_subject as "primarySubj", s_subject as "secondarySubj",
      c::bigint as "semsComplete", i::bigint as "semsInProgress", pc::bigint as "primaryComplete",
      pi::bigint as "primaryInProgress", sc::bigint as "secondaryComplete", si::bigint as "secondaryInProgress",
      oc::bigint as "overflowComplete", oi::bigint as "overflowInProgress", gc::bigint as "semsCompleteGS",
      gi::bigint as "semsInProgressGS" from d5""",
    "dual_postings": """select sid as "studentID", k as subject, ac::bigint as "addComplete",
      ai::bigint as "addInProgress" from posts""",
    "ledger_after_dual": f"select {_LEDGER} from l5",
    "subject_overflow_2": f"select {_OVER} from over2",
    "ledger_settled": f"select {_LEDGER} from l6",
    "subject_status": 'select sid as "studentID", subject, code as "subjOnTrack" from graded',
    "worst_status": 'select sid as "studentID", worst as "minStatus" from worst_code',
    "total_sems": """select sid as "studentID", semester, c::bigint as "semsComplete",
      i::bigint as "semsInProgress" from sems_all""",
    "total_status": 'select sid as "studentID", semester, code as "semStatus" from total_code',
    "final_status": """select sid as "studentID", semester, worst as "minStatus", code as "semStatus",
      code_all as "finalStatus" from final""",
    "overall_status": """select g.sid as "studentID", g.subject, coalesce(f.code_all, 0) as "overallOnTrack"
      from graded g left join final1 f on f.sid = g.sid""",
    "status_publish": f"""select s.sid as "studentID", case when f.sid is null then s.gs
      else {_label('f.code_all')} end as "gradStatus" from status_before s left join final1 f on f.sid = s.sid""",
    "final_report": f"""select sid as "studentID", subject as "hsSubject", c::bigint as "semsComplete",
      i::bigint as "semsInProgress", reqd::int as "semsReqdGrade", close_at::int as "semsReqdClose",
      total::int as "semsReqdTotal", {_LABEL} as "subjStatus" from graded""",
    "update_from": """select s.sid as "studentID", coalesce(t.total, 0)::bigint as sems, s.gs as "gradStatus"
      from status_before s left join (select sid, sum(c + i) as total from l3 group by sid) t on t.sid = s.sid""",
    "refused_students": """select sid as "studentID", subject,
      'a subject has several full requirements' as reason from refused""",
    "ledger_set_aside": """select sid as "studentID", subject, semester, reqd::int as "semsReqdGrade",
      close_at::int as "semsClose", total::int as "semsReqdTotal" from required_twice
      where sid not in (select sid from refused )""",
    "status_set_aside": f"""select s.sid as "studentID", case when f.sid is null then s.gs
      else {_label('f.code_all')} end as "gradStatus" from status_before s
      left join (select * from final1 where sid not in (select sid from refused )) f on f.sid = s.sid""",
    "posting_journal": """select sid as "studentID", rule, f as "fromSubject", t as "toSubject",
      c::bigint as "semsComplete", i::bigint as "semsInProgress", taken, landed from moves""",
    "journal_balances": """select sid as "studentID", k as subject, c::bigint as "semsComplete",
      i::bigint as "semsInProgress" from l6""",
    "published_status": f"""select s.sid as "studentID", case when f.sid is null then s.gs
      else {_label('f.code_all')} end as "gradStatus" from status_before s left join final1 f on f.sid = s.sid""",
    "lost_semesters": """select sid as "studentID", kind, subject, c::bigint as "semsComplete",
      i::bigint as "semsInProgress" from lost""",
}


def expected(year: int = YEAR, mid_year: int = MID_YEAR) -> dict[str, str]:
    steps = _steps(year, mid_year)
    names = [name for name, _ in steps]

    def needed(sql: str) -> set[str]:
        words = set(sql.replace("(", " ").replace(")", " ").replace(".", " ").split())
        direct = {n for n in names if n in words}
        closed = set(direct)
        for n in direct:
            closed |= needed_by[n]
        return closed

    needed_by: dict[str, set[str]] = {}
    for name, sql in steps:
        needed_by[name] = needed(sql) - {name}

    queries = {}
    for key, select in _SELECTS.items():
        wanted = needed(select)
        ctes = ",\n".join(f"{n} as materialized ({sql})" for n, sql in steps if n in wanted)
        queries[key] = f"with {ctes}\n{select}"
    return queries
