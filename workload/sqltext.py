"""SQL fragments shared by the oracles: inputs as CTEs, scalar rules as expressions."""

from __future__ import annotations

from pairloom.functions.text import PAIR_NAME_PREFIX, URL_NAMESPACE, WHITESPACE
from pairloom.operators.checks import PII_PATTERNS

WHITESPACE_RUN = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
NAMES = ("coherence", "accuracy", "helpfulness", "overall")


def strip(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '{WHITESPACE_RUN}', ' ', 'g'))"


def pair_hash(i: str, o: str) -> str:
    return f"sha1({norm(i)} || chr(31) || {norm(o)})"


def uuid5(name: str) -> str:
    h = f"sha1(unhex('{URL_NAMESPACE}') || encode({name}))"
    return (f"(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || "
            f"translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || "
            f"substr(h, 21, 12) FROM (SELECT {h} AS h))")


def pair_id(i: str, o: str) -> str:
    return uuid5(f"'{PAIR_NAME_PREFIX}' || {i} || '::' || {o}")


def pii(blob: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({blob}, '{p}') THEN '{k}'" for k, p in PII_PATTERNS.items())
    return f"CASE {cases} END"


def sha256_rank(seed: int, id_: str = "id", seq: str = "seq") -> str:
    return (f"substr(sha256('{seed}:' || {id_}), 1, 16) || "
            f"substr(sha256('{seed}:' || {id_} || ':' || CAST({seq} AS VARCHAR)), 1, 48)")


DOCS = """docs AS (
  SELECT doc_id AS seq, split_part(text, chr(10), 1) AS prompt, text AS completion, source AS topic, lang AS level
  FROM documents)"""

DIRTY = f"""{DOCS}, broken AS (
  SELECT seq,
    CASE WHEN topic = 'src7' AND level = 'fr' THEN '' WHEN topic = 'src3' AND level = 'de' THEN 'ok' ELSE prompt END AS prompt,
    CASE WHEN topic = 'src11' AND level = 'es' THEN '' ELSE completion END AS completion, topic, level
  FROM docs), dirty AS (
  SELECT * FROM broken UNION ALL
  SELECT seq + 10000000,
    CASE WHEN level = 'en' THEN translate(replace(prompt, ' ', '   '), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE replace(prompt, ' ', '   ') END,
    CASE WHEN level = 'en' THEN translate(replace(completion, ' ', '   '), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') ELSE replace(completion, ' ', '   ') END, topic, level
  FROM broken WHERE topic IN ('src5', 'src10'))"""


def pairs_of(raw: str, name: str = "pairs") -> str:
    return f"""{name} AS (
  SELECT seq, CAST(seq AS VARCHAR) AS id, prompt AS instruction, completion AS output, topic AS category, level AS difficulty
  FROM {raw})"""


TURNS = """nexts AS (
  SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), turns AS (
  SELECT conv_id * 1000 + turn AS seq, text AS question, next_text AS answer
  FROM nexts WHERE role = 'user' AND next_role = 'assistant')"""


def _run(name: str, source: str, doc: str, tag: str) -> str:
    return f"""{name}_s AS (
  SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS pair_id, ({doc}) * 7 % 101 / 1e1 AS coherence,
    ({doc}) * 13 % 101 / 1e1 AS accuracy, ({doc}) * 29 % 101 / 1e1 AS helpfulness FROM {source}), {name}_o AS (
  SELECT *, (coherence + accuracy + helpfulness) / 3 AS overall FROM {name}_s), {name} AS (
  SELECT *, overall >= 7 AND coherence >= 6 AND accuracy >= 6 AND helpfulness >= 6 AS passed, '{tag}' AS tag,
    'formula ' || pair_id AS reasoning FROM {name}_o)"""


RUN_A = _run("ja", "documents", "doc_id", "a")
RUN_B = _run("jb", "(SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))", "doc_id + 37", "b")
LOG = f"""{RUN_A}, {RUN_B}, jlog AS (
  SELECT * FROM ja UNION ALL SELECT * REPLACE (seq + 10000000 AS seq) FROM jb)"""
LAST = f"""{LOG}, jlast AS (
  SELECT * FROM jlog QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY seq DESC) = 1)"""

LABELS = """lab AS (
  SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS pair_id,
    CASE WHEN toxic = 1 THEN 'rejected' WHEN quality = 1 THEN 'approved' ELSE 'needs_edit' END AS status,
    CASE WHEN quality = 1 THEN 'good' END AS tag FROM labels)"""

LABEL_LOG = """llog AS (
  SELECT ts, event_id, CAST(user_id AS VARCHAR) AS pair_id, event_type AS tag,
    CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'rejected' WHEN 'click' THEN 'needs_edit' ELSE 'skipped' END AS status
  FROM events), llast AS (
  SELECT * FROM llog QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY ts DESC, event_id DESC) = 1)"""


def issues_of(pairs: str, name: str = "issues") -> str:
    """The default four checks over a pairs CTE."""
    return f"""hashed AS (SELECT seq, id, {pair_hash('instruction', 'output')} AS h FROM {pairs}), ranked AS (
  SELECT seq, id, row_number() OVER w AS rn, first_value(id) OVER w AS first_id FROM hashed
  WINDOW w AS (PARTITION BY h ORDER BY seq)), kinds AS (
  SELECT seq, id, {pii("instruction || chr(10) || output")} AS kind FROM {pairs}), {name} AS (
  SELECT seq, id AS pair_id, 'schema' AS "check", 'error' AS severity, 'instruction is empty' AS message, 'instruction' AS field
  FROM {pairs} WHERE instruction = ''
  UNION ALL SELECT seq, id, 'schema', 'error', 'output is empty', 'output' FROM {pairs} WHERE output = ''
  UNION ALL SELECT seq, id, 'length', 'warning', 'instruction shorter than 3 chars', 'instruction' FROM {pairs} WHERE length(instruction) < 3
  UNION ALL SELECT seq, id, 'length', 'warning', 'output longer than 8000 chars', 'output' FROM {pairs} WHERE length(output) > 8000
  UNION ALL SELECT seq, id, 'dedup', 'warning', 'duplicate of ' || first_id, NULL FROM ranked WHERE rn > 1
  UNION ALL SELECT seq, id, 'pii', 'warning', 'potential ' || kind || ' detected', NULL FROM kinds WHERE kind IS NOT NULL)"""


COUNTS = """counts AS (
  SELECT "check" AS key, count(*) AS n FROM issues GROUP BY 1
  UNION ALL SELECT 'severity:' || severity, count(*) FROM issues GROUP BY 1)"""


def _num(c: str) -> str:
    return f"CAST(({c}) // 10 AS VARCHAR) || '.' || CAST(({c}) % 10 AS VARCHAR)"


def _responses() -> str:
    items = {n: f"""'"{n}": ' || {n[0]}_text""" for n in NAMES}
    three = " || ', ' || ".join(items[n] for n in NAMES[:3])
    q = " || ', ' || ".join(f"""'"{n}": "' || {n[0]}_text || '"'""" for n in NAMES)
    plain = f"""'{{' || {three} || ', ' || {items['overall']} || ', "passed": true, "reasoning": "formula"}}'"""
    nl = "chr(10)"
    shapes = [
        plain,
        f"'Here it is:' || {nl} || '```json' || {nl} || {plain} || {nl} || '```' || {nl} || 'Done.'",
        f"'```' || {nl} || {plain} || {nl} || '```'",
        f"'My verdict: ' || {plain} || ' as asked.'",
        f"""'{{' || {three} || ', "passed": true}}'""",
        f"""'{{' || {three} || ', ' || {items['overall']} || ', "reasoning": "formula"}}'""",
        f"""'{{' || {q} || ', "reasoning": "formula"}}'""",
        f"""'{{' || {three} || ', ' || {items['overall']} || ', "passed": "false"}}'""",
        f"""'{{"detail": {{"a": 1}}, ' || {three} || '}}'""",
        "'Looks fine, score ' || o_text",
        f"""'{{' || {items['coherence']} || ', "accuracy": null, ' || {items['helpfulness']} || ', ' || {items['overall']} || '}}'""",
        f"""'{{"coherence": 11, ' || {items['accuracy']} || ', ' || {items['helpfulness']} || ', ' || {items['overall']} || '}}'""",
    ]
    cases = " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(shapes))
    return f"""tn AS (SELECT doc_id, doc_id * 7 % 101 AS c, doc_id * 13 % 101 AS a, doc_id * 29 % 101 AS h FROM documents), tt AS (
  SELECT doc_id, {_num('c')} AS c_text, {_num('a')} AS a_text, {_num('h')} AS h_text, {_num('(c + a + h) // 3')} AS o_text FROM tn), resp AS (
  SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS pair_id, CASE doc_id % 12 {cases} END AS response FROM tt)"""


RESPONSES = _responses()


def parsed(source: str = "resp", limits: tuple[float, float, float, float] = (7, 6, 6, 6)) -> str:
    """Judge responses to verdicts, with DuckDB's JSON functions."""
    o, c, a, h = limits
    num = lambda n: f"TRY_CAST(json_extract_string(j, '$.{n}') AS DOUBLE)"
    kind = lambda n: f"json_type(j, '$.{n}')"
    fails = " OR ".join(f"{kind(n)} IN ('NULL', 'ARRAY', 'OBJECT')" for n in NAMES)
    texts = " OR ".join(f"({kind(n)} = 'VARCHAR' AND {num(n)} IS NULL)" for n in NAMES)
    return f"""seg AS (
  SELECT *, CASE WHEN contains(response, '```json') THEN split_part(split_part(response, '```json', 2), '```', 1)
    WHEN contains(response, '```') THEN split_part(split_part(response, '```', 2), '```', 1) ELSE response END AS s FROM {source}), span AS (
  SELECT *, CASE WHEN regexp_matches(s, '\\{{[^}}]+\\}}') THEN regexp_extract(s, '\\{{[^}}]+\\}}') ELSE s END AS js FROM seg), js AS (
  SELECT *, TRY_CAST(js AS JSON) AS j FROM span), vals AS (
  SELECT seq, pair_id, j, coalesce({num('coherence')}, 5) AS c, coalesce({num('accuracy')}, 5) AS a, coalesce({num('helpfulness')}, 5) AS h,
    {num('overall')} AS o0,
    CASE WHEN j IS NULL THEN 'Parse error'
      WHEN {fails} THEN 'Judgment failed: TypeError: float() argument must be a string or a real number, not ''NoneType'''
      WHEN {texts} THEN 'Parse error' END AS problem0 FROM js), full_o AS (
  SELECT *, coalesce(o0, (c + a + h) / 3) AS o FROM vals), prob AS (
  SELECT *, CASE WHEN problem0 IS NOT NULL THEN problem0
    WHEN NOT (c BETWEEN 0 AND 10 AND a BETWEEN 0 AND 10 AND h BETWEEN 0 AND 10 AND o BETWEEN 0 AND 10) THEN 'Judgment failed: ValidationError' END AS problem
  FROM full_o), verdicts AS (
  SELECT seq, pair_id, problem,
    CASE WHEN problem IS NULL THEN c WHEN problem = 'Parse error' THEN 5 ELSE 0 END AS coherence,
    CASE WHEN problem IS NULL THEN a WHEN problem = 'Parse error' THEN 5 ELSE 0 END AS accuracy,
    CASE WHEN problem IS NULL THEN h WHEN problem = 'Parse error' THEN 5 ELSE 0 END AS helpfulness,
    CASE WHEN problem IS NULL THEN o WHEN problem = 'Parse error' THEN 5 ELSE 0 END AS overall,
    CASE WHEN problem IS NOT NULL THEN false
      WHEN json_type(j, '$.passed') IS NULL OR json_type(j, '$.passed') = 'NULL' THEN o >= {o} AND c >= {c} AND a >= {a} AND h >= {h}
      WHEN json_type(j, '$.passed') = 'VARCHAR' THEN json_extract_string(j, '$.passed') <> ''
      ELSE CAST(json_extract_string(j, '$.passed') AS BOOLEAN) END AS passed,
    coalesce(problem, json_extract_string(j, '$.reasoning'), 'No reasoning provided') AS reasoning FROM prob)"""


CONTEXT = f"""{DOCS}, {pairs_of('docs')}, {LAST}, {LABELS}, ctx AS (
  SELECT p.*, coalesce(j.coherence, 0) AS coherence, coalesce(j.accuracy, 0) AS accuracy, coalesce(j.helpfulness, 0) AS helpfulness,
    coalesce(j.overall, 0) AS overall, coalesce(j.passed, false) AS passed, l.status, l.tag AS label_tag
  FROM pairs p LEFT JOIN jlast j ON j.pair_id = p.id LEFT JOIN lab l ON l.pair_id = p.id)"""


def cut_split(source: str, names: list[str], sizes: list[str], seed: int = 42) -> str:
    """Rank by hash, then cut: sizes are SQL over n for all names but the last."""
    upto, cases = "0", ""
    for name, size in zip(names, sizes):
        upto = f"{upto} + {size}"
        cases += f" WHEN rk <= {upto} THEN '{name}'"
    return f"""ranks AS (
  SELECT *, row_number() OVER (ORDER BY {sha256_rank(seed)}) AS rk, count(*) OVER () AS n FROM {source}), splits AS (
  SELECT *, CASE{cases} ELSE '{names[-1]}' END AS split FROM ranks)"""


def share(ratio: float) -> str:
    return f"CAST(floor(n * CAST({ratio} AS DOUBLE)) AS BIGINT)"


CYCLES = f"""{DOCS}, {pairs_of('docs')}, {RUN_A}, cp AS (
  SELECT *, CAST(seq % 4 + 1 AS INTEGER) AS cycle_id FROM pairs), cj AS (
  SELECT *, CAST(seq % 4 + 1 AS INTEGER) AS cycle_id FROM ja), made AS (
  SELECT p.cycle_id, count(*) AS generated, count(*) FILTER (j.passed) AS passed
  FROM cp p LEFT JOIN cj j ON j.pair_id = p.id AND j.cycle_id = p.cycle_id GROUP BY 1), metrics AS (
  SELECT m.cycle_id, m.generated, m.passed, m.generated - m.passed AS failed, m.passed / m.generated AS pass_rate,
    avg(j.overall) AS avg_quality, avg(j.coherence) AS avg_coherence, avg(j.accuracy) AS avg_accuracy,
    avg(j.helpfulness) AS avg_helpfulness, avg(j.overall) AS avg_overall
  FROM made m JOIN cj j ON j.cycle_id = m.cycle_id GROUP BY ALL)"""


def rule_response(prompt_length: str) -> str:
    """The scores of the rule scorer for a request of the given length: coherence, accuracy, helpfulness."""
    return (f"least({prompt_length} // 20, 100) / 1e1 AS coherence, ({prompt_length} % 101) / 1e1 AS accuracy, "
            f"((least({prompt_length} // 20, 100) + {prompt_length} % 101) // 2) / 1e1 AS helpfulness")


def generated(seeds: str = "seeds", name: str = "gp") -> str:
    """Pairs made from seeds by the offline generator."""
    return f"""{name}_s AS (
  SELECT seq, seed, CASE WHEN seq % 7 = 3 THEN 'raw' WHEN seq % 7 IN (4, 5) THEN 'failed' ELSE 'pair' END AS state FROM {seeds}), {name} AS (
  SELECT seq, CAST(seq AS VARCHAR) AS id, seed, CASE WHEN state = 'pair' THEN 'Explain: ' || seed ELSE seed END AS instruction,
    CASE state WHEN 'pair' THEN seed || ' ' || seed WHEN 'raw' THEN 'Sorry: ' || seed ELSE '[Generation failed]' END AS output,
    CASE WHEN state = 'pair' THEN 'echo' END AS category FROM {name}_s)"""


def rule_run(pairs: str, name: str, prompt: str, limits: tuple = (7, 6, 6, 6)) -> str:
    """Verdicts of the rule scorer for a pairs CTE and a rubric's prompt."""
    o, c, a, h = limits
    fixed = len(prompt) - len("{instruction}{output}")
    length = f"({fixed} + length(instruction) + length(output))"
    return f"""{name}_s AS (SELECT seq, id AS pair_id, {rule_response(length)} FROM {pairs}), {name}_o AS (
  SELECT *, (coherence + accuracy + helpfulness) / 3 AS overall FROM {name}_s), {name} AS (
  SELECT *, overall >= {o} AND coherence >= {c} AND accuracy >= {a} AND helpfulness >= {h} AS passed FROM {name}_o)"""
