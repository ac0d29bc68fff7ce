"""SQL fragments of the text functions, for the queries' independent versions."""

WS = "[\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def blank(x: str) -> str:
    return f"(coalesce({strip(x)}, '') = '')"


def ws_norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'), ' ')"


def norm(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'), ' ')"


def byte_norm(x: str) -> str:
    """Normalised text with one byte a character, as levenshtein() here counts bytes: letters beyond ASCII stand as capitals, which no normalised text has."""
    return f"translate({norm(x)}, 'ßàáâäçèéêëìíîïñòóôöùúûüœ', 'ABCDEFGHIJKLMNOPQRSTUVWX')"


#: Chats: one row for each conversation, m = its turns in order.
CHATS = "chats AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m FROM conversations GROUP BY conv_id)"


def head(n: str, k: int) -> str:
    toks = f"list_filter(string_split({n}, ' '), lambda t: t <> '' AND t NOT IN ('user', 'assistant', 'system'))"
    return f"CASE WHEN len({toks}) = 0 THEN '__EMPTY__' ELSE array_to_string({toks}[1:{k}], '_') END"


def levenshtein_score(a: str = "q", b: str = "c") -> str:
    return f"100.0 * (1.0 - CAST(levenshtein({a}.norm, {b}.norm) AS DOUBLE) / greatest({a}.len, {b}.len))"


def near(p: object, before: bool = True) -> str:
    """The join of q and c: blocks, and lengths within reach of the threshold."""
    return f"q.head = c.head AND abs(q.bin - c.bin) <= {p.radius} AND abs(q.len - c.len) <= {p.delta}{' AND c.pos < q.pos' if before else ''} AND abs(q.len - c.len) <= floor({1 - p.threshold / 100} * greatest(q.len, c.len) + 1e-9)"


def pairs_sql(p: object, extra: str = "", name: str = "pairs") -> str:
    """Common tables base(pos, ds, norm, len, head, bin ...) -> owners -> scored pairs q, c, score, offset."""
    return f"""owners AS (SELECT norm, len, head, bin{extra}, min(pos) AS pos, arg_min(ds, pos) AS ds FROM base GROUP BY norm, len, head, bin{extra}),
met AS MATERIALIZED (SELECT q.pos AS q_pos, q.ds AS q_ds, c.pos AS c_pos, c.ds AS c_ds, c.bin - q.bin AS off, q.norm AS qn, c.norm AS cn, greatest(q.len, c.len) AS longer{', q.truth AS q_truth, c.truth AS c_truth' if 'truth' in extra else ''}
  FROM base q JOIN owners c ON {near(p)}),
{name} AS (SELECT * FROM (SELECT * EXCLUDE (qn, cn), 100.0 * (1.0 - CAST(levenshtein(qn, cn) AS DOUBLE) / longer) AS score FROM met) WHERE score >= {p.threshold})"""


def lcs(pairs: str, name: str = "lcs") -> str:
    """Of pairs(id, a, b): (id, n), the length of the longest common subsequence. What both share at either end counts at once; the rest goes by rows of the table of dynamic programming, one for each character of b."""
    return f"""t1 AS (SELECT id, a, b, coalesce(list_position(list_transform(range(1, least(length(a), length(b)) + 1), lambda i: a[i] = b[i]), false) - 1, least(length(a), length(b))) AS front FROM {pairs}),
t2 AS (SELECT id, substr(a, front + 1) AS a, substr(b, front + 1) AS b, front FROM t1),
t3 AS (SELECT id, a, b, front, coalesce(list_position(list_transform(range(1, least(length(a), length(b)) + 1), lambda i: a[length(a) + 1 - i] = b[length(b) + 1 - i]), false) - 1, least(length(a), length(b))) AS back FROM t2),
rest AS MATERIALIZED (SELECT id, substr(a, 1, length(a) - back) AS a, substr(b, 1, length(b) - back) AS b, front + back AS shared FROM t3),
dp AS (SELECT id, CAST(0 AS BIGINT) AS j, i, CAST(0 AS BIGINT) AS v FROM (SELECT id, unnest(range(0, length(a) + 1)) AS i FROM rest)
  UNION ALL SELECT id, j + 1, i, max(w) OVER (PARTITION BY id ORDER BY i) FROM (
    SELECT dp.id, j, i, greatest(v, coalesce(lag(v) OVER (PARTITION BY dp.id ORDER BY i), 0) + CASE WHEN i > 0 AND substr(a, i, 1) = substr(b, j + 1, 1) THEN 1 ELSE 0 END) AS w FROM dp JOIN rest ON rest.id = dp.id WHERE j < length(b))),
{name} AS (SELECT id, any_value(shared) + max(v) AS n FROM dp JOIN rest USING (id) WHERE j = length(b) GROUP BY id)"""
