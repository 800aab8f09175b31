"""The analysis of postings as SQL, for the oracle: each stage is a common table that adds columns."""

from __future__ import annotations

from noticelake.functions import rules as R
from noticelake.functions.dates import LABELLED, RANGE, UNTIL
from noticelake.operators import classify as C
from noticelake.plans.postings import SQL as POSTINGS

AS_OF, YEAR = "2026-06-30", 2026


def has(x: str, patterns: str | list[str]) -> str:
    return f"regexp_matches({x}, '{patterns if isinstance(patterns, str) else R.fused(patterns)}')"


def told(*cases: tuple[str, str]) -> str:
    """A list of the reasons whose condition holds; a reason is SQL."""
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {r} END" for c, r in cases) + "], lambda x: x IS NOT NULL)"


def squash(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def excluded(x: str) -> str:
    for p in R.TEMPORARY_BENIGN:
        x = f"regexp_replace({x}, '{p}', ' ', 'g')"
    return has(x, [*R.EXCLUDED_EMPLOYMENT, *R.TEMPORARY_STRONG])


def employment(x: str) -> str:
    return (
        f"CASE WHEN {excluded(x)} THEN '{C.EXCLUDED}' WHEN {has(x, '무기계약직|기간의' + chr(92) + 's*정함이' + chr(92) + 's*없는' + chr(92) + 's*근로계약')} THEN '무기계약직' WHEN contains({x}, '공무직') THEN '공무직' "
        f"WHEN contains({x}, '상용직') THEN '상용직' WHEN contains({x}, '일반직') THEN '일반직' WHEN contains({x}, '정규직') AND NOT {has(x, C.NOT_REGULAR)} THEN '정규직' ELSE '{C.UNKNOWN_EMPLOYMENT}' END"
    )


def education(x: str) -> str:
    return f"CASE WHEN {has(x, R.DEGREE_REQUIRED)} THEN '{C.DEGREE}' WHEN {has(x, R.HIGH_SCHOOL_OK)} THEN '{C.HIGH_SCHOOL}' ELSE '{C.UNKNOWN_EDUCATION}' END"


def labelled(x: str) -> str:
    lines = f"list_transform(regexp_split_to_array({x}, '\\n|\\r|\\t| {{2,}}'), lambda l: trim(l))"
    return f"left(array_to_string(list_filter({lines}, lambda l: l <> '' AND {has('l', R.LOCATION_LABEL)}), ' '), 1200)"


def location(x: str, label: str) -> str:
    target = f"CASE WHEN {label} <> '' THEN {label} ELSE left({x}, 2400) END"
    elsewhere = has(f"replace({label}, '울산', '')", R.OTHER_REGION)
    here, all_over = has(target, R.ULSAN), has(target, R.NATIONWIDE)
    return f"CASE WHEN {here} AND NOT {elsewhere} AND NOT {all_over} THEN '{C.ULSAN}' WHEN {label} <> '' AND (NOT {here} OR {elsewhere} OR {all_over}) THEN '{C.ELSEWHERE}' ELSE '{C.UNKNOWN_LOCATION}' END"


def category(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {has(x, p)} THEN '{n}'" for n, p in R.CATEGORIES) + " ELSE '기타' END"


def _date(y: str, m: str, d: str) -> str:
    year = f"CASE WHEN coalesce({y}, '') = '' THEN '{YEAR}' WHEN length({y}) = 2 THEN '20' || {y} ELSE {y} END"
    return f"strftime(try_strptime({year} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0'), '%Y-%m-%d'), '%Y-%m-%d')"


def deadline(x: str) -> str:
    g = lambda p, i: f"regexp_extract({x}, '{p}', {i})"
    last = lambda i: f"regexp_extract_all({x}, '{LABELLED}', {i})[-1]"
    until = f"CASE WHEN {has(x, UNTIL)} THEN {_date(g(UNTIL, 1), g(UNTIL, 2), g(UNTIL, 3))} END"
    label = f"CASE WHEN {has(x, LABELLED)} THEN {_date(last(1), last(2), last(3))} END"
    return f"CASE WHEN {has(x, RANGE)} THEN coalesce({_date(g(RANGE, 4), g(RANGE, 5), g(RANGE, 6))}, '') ELSE coalesce({until}, {label}, '') END"


ALLOWED = "employment IN (" + ", ".join(f"'{e}'" for e in R.ALLOWED_EMPLOYMENT) + ")"
HIGH, ULSAN = f"education = '{C.HIGH_SCHOOL}'", f"location = '{C.ULSAN}'"
_SUFFICIENT = f"(length(detail_text) >= 120 OR (length(detail_text) >= 55 AND CAST({HIGH} AS INT) + CAST({ULSAN} AS INT) + CAST({ALLOWED} AS INT) + CAST({has('detail_text', '채용인원|모집인원|' + chr(92) + 'd+명')} AS INT) >= 4))"

ANALYSIS = rf"""{POSTINGS},
texts AS (SELECT *, regexp_replace(concat_ws(chr(10), trim(title), list_text, detail_text, document_text), '[ \t]+', ' ', 'g') AS full_text FROM postings),
labels AS (SELECT *, {labelled("full_text")} AS lf, {labelled("detail_text")} AS ld, {labelled("document_text")} AS lo, {squash("detail_text")} AS flat FROM texts),
verdicts AS (SELECT *, {employment("full_text")} AS employment, {education("full_text")} AS education, {location("full_text", "lf")} AS location, {category("full_text")} AS category,
  {employment("detail_text")} AS de, {employment("document_text")} AS oe, {education("detail_text")} AS dd, {education("document_text")} AS od,
  {location("detail_text", "ld")} AS dl, {location("document_text", "lo")} AS ol, length(document_text) >= 40 AS checked, {deadline("flat")} AS deadline FROM labels),
crossed AS (SELECT *, {
    told(
        (f"checked AND de IN ({', '.join(repr(e) for e in R.ALLOWED_EMPLOYMENT)}) AND oe = '{C.EXCLUDED}'", "'본문과 첨부문서의 고용형태 충돌'"),
        (f"checked AND dd = '{C.HIGH_SCHOOL}' AND od = '{C.DEGREE}'", "'본문과 첨부문서의 학력 조건 충돌'"),
        (f"checked AND dl = '{C.ULSAN}' AND ol = '{C.ELSEWHERE}'", "'본문과 첨부문서의 근무지 충돌'"),
    )
} AS conflicts FROM verdicts),
excluding AS (SELECT *, {_SUFFICIENT} AS sufficient, list_concat({
    told(
        (has("trim(title)", R.NON_JOB), "'채용공고가 아닌 안내·결과 공지'"),
        (excluded("full_text"), "'인턴·기간제·계약직 등 제외 고용형태'"),
        (f"({has('trim(title)', R.LICENSE_JOB)} OR {has('full_text', R.REQUIRED_LICENSE)})", "'전문면허·전문자격 필수 직무'"),
        (f"education = '{C.DEGREE}'", "'전문학사·학사 이상 조건'"),
        (f"location = '{C.ELSEWHERE}'", "'울산 단일 근무가 아님'"),
    )
}, conflicts) AS exclude_reasons FROM crossed),
judged AS (SELECT *, len(exclude_reasons) > 0 AS excluded, len(exclude_reasons) = 0 AND detail_ok AND sufficient AND {HIGH} AND {ULSAN} AND {ALLOWED} AS recommended FROM excluding),
analysis AS (SELECT *, CASE WHEN recommended THEN 100 WHEN excluded THEN 0 ELSE least(25 + 20 * (CAST({HIGH} AS INT) + CAST({ULSAN} AS INT) + CAST({ALLOWED} AS INT)) + 10 * CAST(detail_ok AS INT), 90) END AS fit_score,
  CASE WHEN recommended THEN '지원 추천' WHEN excluded THEN '제외' ELSE '확인 필요' END AS status FROM judged)"""

_TOKENS = r"list_slice(list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(regexp_replace(title, '\[[^\]]+\]|\([^)]*\)', ' ', 'g'), '(?:채용|모집|공고|직원|신입|경력|정규직|공무직|무기계약직)', ' ', 'g'), '[^0-9a-zA-Z가-힣]+', ' ', 'g')), '\s+'), lambda w: length(w) >= 2), 1, 8)"
_SIGNALS = " + ".join(f"CAST({has('detail_text', p)} AS INT)" for p in R.STRUCTURE_SIGNALS)
_KEYS = r"regexp_split_to_array(regexp_extract(link, '^[^?#]*\?([^#]*)', 1), '&')"
_VALID = r"regexp_matches(link, '^[a-zA-Z][\w+.-]*://[^\s/?#]+')"
_PATH = r"regexp_extract(link, '^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)', 1)"
_RAW = "(title || chr(10) || detail_text)"

QUALITY = rf"""{ANALYSIS},
tokens AS (SELECT *, {_SIGNALS} AS signals, {_TOKENS} AS words, {_VALID} AND ({has(_PATH, R.DETAIL_PATH)} OR len(list_filter({_KEYS}, lambda k: {has("regexp_extract(k, '^([^=]*)', 1)", R.DETAIL_KEY)})) > 0) AS identified FROM analysis),
ratios AS (SELECT *, CASE WHEN len(words) > 0 THEN len(list_filter(words, lambda w: contains(detail_text, w))) / len(words) ELSE 1.0 END AS ratio FROM tokens),
scored AS (SELECT *, CASE WHEN excluded THEN 0 ELSE least(greatest(CASE WHEN detail_ok THEN 22 ELSE 0 END + CASE WHEN signals >= 5 THEN 14 WHEN signals >= 3 THEN 10 ELSE 0 END
  + CASE WHEN ratio >= 0.67 THEN 12 WHEN ratio >= 0.4 THEN 7 ELSE 0 END + CASE WHEN documents_read > 0 THEN 8 ELSE 0 END - CASE WHEN len(conflicts) > 0 THEN 35 ELSE 0 END
  + CASE WHEN {HIGH} THEN 14 ELSE 0 END + CASE WHEN {ULSAN} THEN 14 ELSE 0 END + CASE WHEN {ALLOWED} THEN 12 ELSE 0 END + CASE WHEN deadline <> '' THEN 5 ELSE 0 END + CASE WHEN identified THEN 4 ELSE 0 END, 0), 100) END AS quality_score FROM ratios),
validated AS (SELECT *, recommended AND len(conflicts) = 0 AND quality_score >= 90 AS quality_passed, {
    told(
        ("link = ''", "'원문 링크 누락'"),
        (f"link <> '' AND NOT {_VALID}", "'원문 링크 형식 오류'"),
        (rf"{_VALID} AND NOT regexp_matches(link, '^(?i:https?)://')", "'HTTP 원문 링크 아님'"),
        (f"{_VALID} AND {has(_PATH, R.LIST_OR_HOME)} AND NOT contains(link, '?')", "'목록 또는 메인 링크'"),
        (has(_RAW, R.ERROR_TEXT), "'오류 페이지 문구 포함'"),
        (has(_RAW, R.CLOSED_TEXT), "'마감 문구 포함'"),
        (f"(employment = '{C.EXCLUDED}' OR {excluded(_RAW)})", "'제외 고용형태 포함'"),
        (f"NOT ({HIGH})", "'고졸 지원 확인 안 됨'"),
        (f"NOT ({ULSAN})", "'울산 단일 근무 확인 안 됨'"),
        (f"NOT ({ALLOWED})", "'허용 고용형태 아님'"),
        ("quality_score < 90", "'품질점수 미달'"),
        ("NOT detail_ok", "'상세 원문 미검증'"),
    )
} AS errors FROM scored)"""


# Vacancies: the postings by the name of notices, their blocks, and one posting for each vacancy, analysed as all are.
_BLOCKS = rf"""{POSTINGS.replace("postings AS (", "notices AS (", 1)},
lines AS (SELECT posting_id, title, unnest(string_split(detail_text || chr(10) || document_text, chr(10))) AS line, generate_subscripts(string_split(detail_text || chr(10) || document_text, chr(10)), 1) AS pos FROM notices),
flat AS (SELECT posting_id, title, pos, trim(regexp_replace(line, '\s+', ' ', 'g')) AS line FROM lines WHERE length(line) BETWEEN 2 AND 700),
numbered AS (SELECT *, sum(CAST(regexp_matches(line, '^(?:모집|채용)\s*(?:분야|직무|직종|직렬)') AS INT)) OVER (PARTITION BY posting_id ORDER BY pos) AS block FROM flat),
blocks AS (SELECT posting_id, block, string_agg(line, chr(10) ORDER BY pos) AS local_text, regexp_replace(first(line ORDER BY pos), '^(?:모집|채용)?\s*(?:분야|직무|직종|직렬|구분)\s*[:：]?\s*', '') AS name FROM numbered WHERE block > 0 GROUP BY 1, 2 HAVING length(string_agg(line, ' ' ORDER BY pos)) >= 25),
two AS (SELECT posting_id, count(*) AS n FROM blocks GROUP BY 1 HAVING count(*) >= 2),
common AS (SELECT posting_id, string_agg(line, chr(10) ORDER BY pos) AS shared FROM (SELECT posting_id, line, min(pos) AS pos FROM flat WHERE {has("line", [R.VACANCY_GLOBAL, R.VACANCY_GLOBAL_START])} GROUP BY 1, 2) GROUP BY 1),
parts AS (SELECT posting_id, 'vacancy-' || row_number() OVER (PARTITION BY posting_id ORDER BY block) AS vacancy_id, name, local_text, n AS vacancy_count FROM blocks JOIN two USING (posting_id)
  UNION ALL SELECT posting_id, 'vacancy-1', '', detail_text || chr(10) || document_text, 1 FROM notices WHERE posting_id NOT IN (SELECT posting_id FROM two)),
postings AS (SELECT n.* EXCLUDE (title, detail_text), n.title AS original_title, CASE WHEN vacancy_count > 1 THEN n.title || ' ' || name ELSE n.title END AS title, vacancy_id, name AS vacancy_name, vacancy_count,
  regexp_replace(concat_ws(chr(10), coalesce(shared, ''), local_text), '^\s+|\s+$', '', 'g') AS detail_text FROM parts JOIN notices n USING (posting_id) LEFT JOIN common USING (posting_id))"""


def of_vacancies(sql: str) -> str:
    """An analysis of postings made one of vacancies, for which three signals are enough where a posting has several."""
    return _BLOCKS + sql.removeprefix(POSTINGS).replace(">= 4))", ">= CASE WHEN vacancy_count > 1 THEN 3 ELSE 4 END))")


def title_key(x: str) -> str:
    for p in (r"\[(?:수정|변경|재공고|재재공고)\]", r"\((?:수정|변경|재공고|재재공고)\)", r"(?:수정|변경|재재?공고)", r"제?\d+차", r"\d{4}[-.년\s]*\d{0,2}[-.월\s]*\d{0,2}일?", r"[^0-9a-zA-Z가-힣]+"):
        x = f"regexp_replace({x}, '{p}', ' ', 'g')"
    return f"lower({squash(x)})"


REVISION = "CASE WHEN contains(title, '재재공고') THEN 4 WHEN contains(title, '재공고') THEN 3 WHEN regexp_matches(title, '수정|변경') THEN 2 ELSE 1 END"
