"""SQL with which DuckDB follows the queries: the records view, its normalization, blocking keys and what stands on them.

The records view's countries are languages, so that only the rules for other countries apply; its texts have no punctuation but commas."""

from __future__ import annotations

from ..functions import dictionaries as D
from ..operators.blocking import PASSES, Settings


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


RECORDS = r"""
rec0 AS (SELECT doc_id, lang, n_chars, 1 + CAST(substr(source, 4) AS INT) % 3 AS sn, md5(text) AS text_key,
  list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^\p{L}\p{N}\p{M}\s]', ' ', 'g'), '\s+'), lambda x: x <> '') AS t FROM documents),
rec AS (SELECT doc_id, sn, 'S' || sn || '-' || doc_id AS entity_id, array_to_string(t[1:4], ' ') AS business_name,
  n_chars || ' ' || array_to_string(t[5:8], ' ') || ', ' || array_to_string(t[9:12], ' ') || ', ' || (10000 + n_chars % 997) AS business_address,
  lang AS country, text_key FROM rec0)"""

_REPEATS = "list_transform(list_filter(list_zip({0}, list_concat(CAST([NULL] AS VARCHAR[]), {0}[1:len({0}) - 1])), lambda z: z[1] IS DISTINCT FROM z[2]), lambda z: z[1])"
_LEET = "CASE WHEN regexp_matches(x, '^[a-z]+[0-9][a-z0-9]*$') AND length(regexp_replace(x, '[^a-z]', '', 'g')) >= 3 THEN translate(x, '013457', 'oleast') ELSE x END"
_ZEROS = "CASE WHEN regexp_matches({0}, '^[0-9]+$') THEN CASE WHEN ltrim({0}, '0') = '' THEN '0' ELSE ltrim({0}, '0') END ELSE {0} END"
_WORDS = r"list_filter(regexp_split_to_array(regexp_replace({0}, '[^\p{{L}}\p{{N}}\s]', ' ', 'g'), '\s+'), lambda x: x <> '')"

_NAME_ID = r"regexp_replace(strip_accents(business_name), '\bid\s*\d+', ' ', 'g')"
_PARTED = r"regexp_replace(regexp_replace(regexp_replace(part, '\b(\d+)(?:st|nd|rd|th)\b', '\1', 'g'), '([0-9])(\p{L})', '\1 \2', 'g'), '(\p{L})([0-9])', '\1 \2', 'g')"

NORM = rf"""
nm0 AS (SELECT entity_id, country, {_WORDS.format(_NAME_ID)} AS raw FROM rec),
nm1 AS (SELECT entity_id, country, list_transform(list_transform(list_filter(raw, lambda x: NOT (regexp_matches(x, '^[0-9]+$') AND length(x) > 4)), lambda x: {_LEET}),
  lambda x: coalesce({_map(D.NAME_ABBREVIATIONS)}[x], x)) AS names0 FROM nm0),
nm2 AS (SELECT entity_id, country, {_REPEATS.format("names0")} AS names FROM nm1),
nm AS (SELECT entity_id, country, array_to_string(names, ' ') AS name_norm,
  array_to_string(CASE WHEN len(list_filter(names, lambda x: NOT list_contains({_list(D.NAME_STOP)}, x))) > 0 THEN list_filter(names, lambda x: NOT list_contains({_list(D.NAME_STOP)}, x)) ELSE names END, ' ') AS name_core FROM nm2),
ad0 AS (SELECT entity_id, unnest(string_split(strip_accents(business_address), ',')) AS part, generate_subscripts(string_split(business_address, ','), 1) AS k FROM rec),
ad1 AS (SELECT entity_id, k, {_WORDS.format(_PARTED)} AS raw FROM ad0),
ad2 AS (SELECT entity_id, k, raw, list_transform(list_filter(raw, lambda x: NOT list_contains({_list(D.ADDRESS_STOP)}, x)), lambda x: coalesce({_map(D.ADDRESS_ABBREVIATIONS[""])}[x], x)) AS m0,
  list_filter(raw, lambda x: regexp_matches(x, '^[0-9]+$')) AS digits FROM ad1 WHERE len(raw) > 0),
ad3 AS (SELECT *, {_REPEATS.format("m0")} AS mapped,
  CASE WHEN regexp_matches(raw[1], '^[0-9]{{5}}$') AND (len(raw) = 1 OR (len(digits) = 1 AND NOT list_has_any(m0, {_list(D.STREET)}))) THEN raw[1] END AS pc FROM ad2),
ad4 AS (SELECT entity_id, flatten(list(list_transform(mapped, lambda x: {_ZEROS.format("x")}) ORDER BY k)) AS toks, flatten(list(digits ORDER BY k)) AS nums0, coalesce(arg_max(pc, k) FILTER (pc IS NOT NULL), '') AS postcode FROM ad3 GROUP BY entity_id),
ad5 AS (SELECT entity_id, {_REPEATS.format("toks")} AS toks, postcode, list_filter(list_distinct(list_transform(nums0, lambda x: {_ZEROS.format("x")})), lambda x: postcode = '' OR x <> {_ZEROS.format("postcode")}) AS nums FROM ad4),
norm AS (SELECT nm.entity_id, country, name_norm, name_core, coalesce(array_to_string(toks, ' '), '') AS addr_norm,
  coalesce(array_to_string(list_transform(list_sort(list_transform(nums, lambda x: {{'l': length(x), 'n': x}})), lambda s: s.n), ' '), '') AS addr_nums, coalesce(postcode, '') AS postcode, '' AS state
  FROM nm LEFT JOIN ad5 USING (entity_id))"""


def blocking(settings: Settings = Settings(), only: str | None = None) -> str:
    """WITH tables up to `pairs`; of one pass where `only` names it."""
    s = settings
    sides = []
    for side, where, pair_words, num_words in (("q", "LIKE 'S1-%'", s.pair_words_query, s.num_words_query), ("i", "NOT LIKE 'S1-%'", s.pair_words_index, s.num_words_index)):
        r = f"(SELECT * FROM rk WHERE entity_id {where})"
        one = {
            "name_pair": f"SELECT entity_id, country, 'np|' || array_to_string(list_sort(kn[1:2]), '|') AS key, 1 AS bit FROM {r} WHERE len(kn) > 0",
            "name_rare": f"SELECT entity_id, country, 'nr|' || unnest(list_transform(list_filter(kns[1:3], lambda x: x.df <= {s.rare_df}), lambda x: x.t)), 2 FROM {r}",
            "name_prefix": f"SELECT entity_id, country, 'pp|' || array_to_string(list_sort(kp[1:2]), '|'), 4 FROM {r} WHERE len(kp) >= 2",
            "addr": f"SELECT entity_id, country, 'ad|' || n || '|' || w, 8 FROM (SELECT entity_id, country, unnest(nums[1:{s.max_nums}]) AS n, ka FROM {r}), unnest(ka[1:2]) AS u(w)",
            "postcode": f"SELECT entity_id, country, 'pc|' || postcode || '|' || kn[1], 16 FROM {r} WHERE postcode <> '' AND len(kn) > 0 UNION ALL SELECT entity_id, country, 'pn|' || postcode || '|' || unnest(nums[1:2]), 16 FROM {r} WHERE postcode <> ''",
            "addr_pair": f"SELECT entity_id, country, 'aw|' || least(x, y) || '|' || greatest(x, y), 32 FROM (SELECT entity_id, country, x, ka FROM {r}, unnest(ka[1:{pair_words}]) AS u(x)), unnest(ka[1:{pair_words}]) AS v(y) WHERE x < y",
            "addr_num_all": f"SELECT entity_id, country, 'ad|' || n || '|' || w, 64 FROM (SELECT entity_id, country, unnest(nums[1:2]) AS n, ka FROM {r}), unnest(ka[3:{num_words}]) AS u(w)",
            "name_nospace": f"SELECT entity_id, country, 'ns|' || g, 128 FROM {r} WHERE length(g) >= 6 UNION ALL SELECT entity_id, country, 'n8|' || substr(g, 1, 8), 128 FROM {r} WHERE length(g) >= 10",
            "addr_prefix": f"SELECT entity_id, country, 'ax|' || n || '|' || w, 256 FROM (SELECT entity_id, country, unnest(nums[1:2]) AS n, a5 FROM {r}), unnest(a5) AS u(w) UNION ALL "
            f"SELECT entity_id, country, 'aq|' || x || '|' || y, 256 FROM (SELECT entity_id, country, x, a5 FROM {r}, unnest(a5) AS u(x)), unnest(a5) AS v(y) WHERE x < y",
        }
        sides.append(f"{side}k(entity_id, key, bit) AS (SELECT DISTINCT entity_id, country || '|' || key, bit FROM (" + " UNION ALL ".join(q for n, q in one.items() if only in (None, n)) + ") AS u(entity_id, country, key, bit))")
    generic = f"length(t) >= 3 AND NOT regexp_matches(t, '^[0-9]+$') AND NOT list_contains({_list(D.GENERIC)}, t)"
    cap = f"QUALIFY row_number() OVER (PARTITION BY s1_entity_id ORDER BY n_passes DESC, candidate_entity_id) <= {s.max_cands}" if s.max_cands else ""
    return rf"""{RECORDS}, {NORM},
tk AS (SELECT entity_id, country, 'n' AS kind, unnest(list_distinct(list_filter(string_split(name_core, ' '), lambda x: x <> ''))) AS t FROM norm
  UNION ALL SELECT entity_id, country, 'a', unnest(list_distinct(list_filter(string_split(addr_norm, ' '), lambda x: x <> ''))) FROM norm),
tp AS (SELECT * FROM tk UNION ALL SELECT DISTINCT entity_id, country, 'p', substr(t, 1, 4) FROM tk WHERE kind = 'n' AND length(t) >= 3),
df AS (SELECT kind, country, t, count(*) AS df FROM tp WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL),
td AS (SELECT tp.entity_id, kind, t, coalesce(df, 0) AS df FROM tp LEFT JOIN df USING (kind, country, t)),
tg AS (SELECT entity_id,
  list(t ORDER BY df, t) FILTER (kind = 'n' AND df > 0 AND length(t) >= 2) AS kn, list({{'df': df, 't': t}} ORDER BY df, t) FILTER (kind = 'n' AND df > 0 AND length(t) >= 2) AS kns,
  list(t ORDER BY df, t) FILTER (kind = 'p' AND df > 0) AS kp, list(t ORDER BY df, t) FILTER (kind = 'a' AND df > 0 AND {generic}) AS ka,
  list(t ORDER BY df, t) FILTER (kind = 'a' AND length(t) >= 5 AND {generic}) AS aa FROM td GROUP BY entity_id),
rk AS (SELECT norm.entity_id, country, postcode, replace(name_core, ' ', '') AS g, kn, kns, kp, ka,
  list_transform(list_sort(list_transform(list_filter(string_split(addr_nums, ' '), lambda x: x <> ''), lambda x: {{'l': -length(x), 'n': x}})), lambda s: s.n) AS nums,
  list_distinct(list_transform(aa[1:{s.prefix_words}], lambda x: substr(x, 1, 5))) AS a5 FROM norm LEFT JOIN tg USING (entity_id)),
{", ".join(sides)},
few AS (SELECT key FROM (SELECT DISTINCT entity_id, key FROM ik) GROUP BY key HAVING count(*) <= {s.max_block}),
met AS (SELECT qk.entity_id AS s1_entity_id, x.entity_id AS candidate_entity_id, bit_or(qk.bit) AS passes FROM qk JOIN (SELECT DISTINCT entity_id, key FROM ik SEMI JOIN few USING (key)) x USING (key) GROUP BY ALL),
pairs AS (SELECT s1_entity_id, candidate_entity_id, CAST(passes AS SMALLINT) AS passes, CAST(bit_count(passes) AS TINYINT) AS n_passes FROM met {cap}),
links AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS matched_entity_id FROM rec a JOIN rec b ON a.country = b.country AND a.text_key = b.text_key WHERE a.sn = 1 AND b.sn > 1)"""


PASS_NAMES = list(PASSES)

_W = "list_filter(string_split({0}, ' '), lambda x: x <> '')"
_LONGEST = "coalesce(list_sort(list_transform(list_filter({0}, lambda x: length(x) = list_max(list_transform({0}, lambda y: length(y)))), lambda x: {{'p': list_position({0}, x), 'x': x}}))[1].x, '')"


def scored(only: str | None) -> str:
    """Set features of the pairs of one pass (None: of all passes), and a score that SQL can compute from them."""
    return f"""{blocking(only=only)},
fx AS (SELECT p.*, a.country, a.name_core AS a_name_core, b.name_core AS b_name_core, a.addr_norm AS a_addr_norm, b.addr_norm AS b_addr_norm, a.postcode AS apc, b.postcode AS bpc,
  list_distinct({_W.format("a.name_core")}) AS ant, list_distinct({_W.format("b.name_core")}) AS bnt, list_distinct({_W.format("a.addr_norm")}) AS aat, list_distinct({_W.format("b.addr_norm")}) AS bat,
  {_W.format("a.addr_nums")} AS ann, {_W.format("b.addr_nums")} AS bnn, {_W.format("a.name_core")}[1] AS af, {_W.format("b.name_core")}[1] AS bf
  FROM pairs p JOIN norm a ON a.entity_id = s1_entity_id JOIN norm b ON b.entity_id = candidate_entity_id),
fy AS (SELECT *, len(list_intersect(ant, bnt)) AS nc, len(list_intersect(aat, bat)) AS ac, len(list_intersect(ann, bnn)) AS mc, len(ant) > 0 AND len(bnt) > 0 AS nf, len(aat) > 0 AND len(bat) > 0 AS af2, len(ann) > 0 AND len(bnn) > 0 AS mf FROM fx),
ft AS (SELECT s1_entity_id, candidate_entity_id, country, passes, n_passes, a_name_core, b_name_core, b_addr_norm,
  CAST(a_name_core = b_name_core AS INT) AS name_exact, round(CASE WHEN nf THEN nc / (len(ant) + len(bnt) - nc) ELSE 0.0 END, 6) AS name_tok_jacc, CAST(coalesce(nf AND af = bf, false) AS INT) AS name_first_eq,
  CAST(abs(length(a_name_core) - length(b_name_core)) AS INT) AS name_len_diff, CAST(length(a_name_core) - length(replace(a_name_core, ' ', '')) + 1 AS INT) AS name_ntok_a, CAST(length(b_name_core) - length(replace(b_name_core, ' ', '')) + 1 AS INT) AS name_ntok_b,
  CAST(a_addr_norm = '' AS INT) AS addr_empty_a, CAST(b_addr_norm = '' AS INT) AS addr_empty_b, round(CASE WHEN af2 THEN ac / len(aat) ELSE 0.0 END, 6) AS addr_contain_a, round(CASE WHEN af2 THEN ac / len(bat) ELSE 0.0 END, 6) AS addr_contain_b,
  CAST(len(bnn) > 0 AND mc = len(bnn) AS INT) AS num_subset_b, CAST(mf AS INT) AS num_both, CAST(CASE WHEN mf THEN mc ELSE 0 END AS INT) AS num_common, round(CASE WHEN mf THEN mc / (len(ann) + len(bnn) - mc) ELSE 0.0 END, 6) AS num_jacc,
  CAST(mf AND {_LONGEST.format("ann")} = {_LONGEST.format("bnn")} AS INT) AS num_long_eq, CAST(mf AND mc = 0 AS INT) AS num_conflict, CAST(apc <> '' AND bpc <> '' AND apc = bpc AS INT) AS pc_eq, CAST(apc <> '' AND bpc <> '' AND apc <> bpc AS INT) AS pc_conflict,
  CAST(candidate_entity_id LIKE 'S3-%' AS INT) AS cand_is_s3 FROM fy),
scores AS (SELECT s1_entity_id, candidate_entity_id, country, n_passes, b_name_core, b_addr_norm, round((name_tok_jacc + addr_contain_a) / 2, 6) AS score FROM ft),
entities AS (SELECT entity_id AS s1_entity_id, country FROM rec WHERE sn = 1)"""


SCORED = scored("name_pair")


def selected(threshold: str = "0.5", top1: str = "NULL", one_owner: bool = True, within: str = "", source: str = "scores", name: str = "sel") -> str:
    """CTEs that end in `name`: the kept pairs."""
    by = f"{within}, " if within else ""
    owner = f"QUALIFY row_number() OVER (PARTITION BY {by}candidate_entity_id ORDER BY score DESC, s1_entity_id) = 1" if one_owner else ""
    return f"""{name}0 AS (SELECT * FROM (SELECT *, {threshold} AS thr, CAST({top1} AS DOUBLE) AS t1 FROM {source}) WHERE score >= least(thr, coalesce(t1, thr)) {owner}),
{name} AS (SELECT * EXCLUDE (thr, t1, k) FROM (SELECT *, row_number() OVER (PARTITION BY {by}s1_entity_id ORDER BY score DESC, candidate_entity_id) AS k FROM {name}0) WHERE score >= thr OR (t1 IS NOT NULL AND k = 1))"""


def by_entity(source: str = "sel", name: str = "ent", within: str = "", points: str = "") -> str:
    """CTEs that end in `name`: every entity's figures (at every point of the grid)."""
    by, use = (f"{within}, ", f", {within}") if within else ("", "")
    frame = f"(SELECT * FROM entities CROSS JOIN {points})" if points else "entities"
    return f"""{name}p AS (SELECT {by}s1_entity_id, count(*) AS n_pred, count(matched_entity_id) AS tp FROM {source} LEFT JOIN links ON s1_entity_id = source1_entity_id AND candidate_entity_id = matched_entity_id GROUP BY ALL),
{name}t AS (SELECT source1_entity_id AS s1_entity_id, count(*) AS n_true FROM links GROUP BY ALL),
{name}0 AS (SELECT f.*, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM {frame} f LEFT JOIN {name}t USING (s1_entity_id) LEFT JOIN {name}p USING (s1_entity_id{use})),
{name} AS (SELECT *, n_pred - tp AS fp, n_true - tp AS fn, CASE WHEN tp > 0 THEN 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) WHEN n_pred = 0 AND n_true = 0 THEN 1.0 ELSE 0.0 END AS f05 FROM {name}0)"""
