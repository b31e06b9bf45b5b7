"""One query for each operator over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.llm import alignment, bpe, collocations, crosspolytope, huffman, langid, mixing, repetition, secrets, sharding, simhash, substring_dedup, warc
from folia.session import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.kd_shards(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = langid.fit_dictionaries(docs.where(~langid.held_out()))
    out = langid.identify(docs.select("doc_id", "text"), known)
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op4_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repetition.quality_rules(table(spark, sf_dir, "documents"))
    return out.drop("spans", "longest_repeat").withColumn("covered_fraction", F.round("covered_fraction", 6))


def op6_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE, with_ids=False)


def op7_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_passages(table(spark, sf_dir, "documents"), keep_text=False)


def op8_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.tokens_to_files(table(spark, sf_dir, "documents"), WORD_BPE)


def op10_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.nearest(table(spark, sf_dir, "embeddings"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.align_tokenizers(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return out.select("doc_id", *alignment.FIGURES, digest.alias("groups_sha256"))


def op12_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    kinds = ", ".join(f"'{k}'" for k in secrets.KINDS)
    form = "array_join(transform({}, s -> concat(element_at(array(" + kinds + "), s.kind + 1), ':', s.start, ':', s.end)), ',')"
    count = lambda test: F.expr(f"cast(size(filter(spans, s -> {test})) as long)")
    return out.select(
        "doc_id", *[count(f"s.kind = {k}").alias(f"n_{n}") for k, n in enumerate(secrets.KINDS)], count("s.n_owners > 1").alias("n_copied"),
        F.sha2(F.expr(form.format("filter(spans, s -> s.kind < 3)")), 256).alias("base_sha256"), F.expr(form.format("spans")).alias("spans"),
    )


QUERIES = {f.__name__: f for f in (
    op1_kd_shards, op2_cube_mix, op3_zstd_language, op4_indexed_warc, op5_suffix_repetition,
    op6_pair_index_bpe, op7_difference_cover, op8_anchor_simhash, op9_huffman_ids, op10_cross_polytope,
    op11_token_alignment, op12_son_phrases, op13_secret_ownership,
)}

# Fixed value: the RFC 4648 alphabet of base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HEX = "('0x' || substr(h, {0}, 5))::INTEGER"
_LETTERS = " || ".join(
    f"substr('{BASE32}', ((({_HEX.format(5 * k + 1)}) >> {s}) & 31) + 1, 1)" for k in range(8) for s in (15, 10, 5, 0)
)

_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
_SYMBOLS = "len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))"


def _repeated(n: int, name: str) -> str:
    """Starts of the n-word windows that occur twice or more in their text."""
    return f"""{name} AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, h) AS n
        FROM (SELECT doc_id, s, hash(w[s:s+{n - 1}]) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS s FROM d WHERE len(w) >= {n}))) WHERE n > 1)"""


def _covered(n: int, name: str) -> str:
    return f"(SELECT doc_id, count(DISTINCT s + i) AS {name} FROM {name}_, range({n}) t(i) GROUP BY 1)"




def _letters(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_QUOTE = """["'']?"""
#: Patterns of the secret scan, without case folding beyond A-Z.
_SECRETS = {
    "assign": f"({'|'.join(map(_letters, ('password', 'passwd', 'secret', 'token', 'api_?key')))}){_QUOTE}\\x20*[:=]\\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+", "owned": "[A-Za-z0-9+/_=-]{20,}",
}


def _found(kind: str, order: int) -> str:
    """Matches of a kind with their places: the lengths of what stands between and of the matches before are added up."""
    pattern = _SECRETS[kind]
    return f"""SELECT doc_id, source, '{kind}' AS kind, {order} AS o, m[i] AS m,
        coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS s
        FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, source, regexp_extract_all(t, '{pattern}') AS m, string_split(regexp_replace(t, '{pattern}', chr(1), 'g'), chr(1)) AS p FROM d))"""


ORACLE_SQL = {
    "op5_suffix_repetition": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        {_repeated(3, 'three_')}, {_repeated(8, 'eight_')}, {_repeated(61, 'long_')},
        l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) > 0) AS l FROM d),
        b AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, {_SYMBOLS}::BIGINT AS n_symbols,
                     (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(three, 0)::BIGINT AS n_repeat_words, coalesce(eight, 0) / greatest(len(w), 1) AS share,
                     doc_id IN (SELECT doc_id FROM long_) AS too_long
              FROM d JOIN l USING (doc_id) LEFT JOIN {_covered(3, 'three')} USING (doc_id) LEFT JOIN {_covered(8, 'eight')} USING (doc_id)),
        v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND share <= 0.3 AND NOT too_long AS kept, round(share, 6) AS covered_fraction FROM v""",
    "op7_difference_cover": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        win AS (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS r FROM (SELECT doc_id, s, hash(w[s:s+19]) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20))),
        gone AS (SELECT DISTINCT doc_id, s + i AS pos FROM win, range(20) t(i) WHERE r > 1),
        x AS (SELECT doc_id, w, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
        k AS (SELECT x.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS kept FROM x ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op4_indexed_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS h FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS least FROM d)
        SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
               CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to
        FROM f""",
    "op12_son_phrases": """
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        tot AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
        g AS (SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM w, range(1, 5) t(k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
        c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        i AS (SELECT lang, a, array_to_string(w[s:s + m - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
        o AS (SELECT lang, phrase, max(a) AS longer FROM i GROUP BY ALL),
        x AS (SELECT c.lang, c.phrase, c.a, h, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
              FROM (SELECT *, unnest(range(1, k)) AS h FROM c) c
              JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:h], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[h + 1:], ' ')
              LEFT JOIN o ON o.lang = c.lang AND o.phrase = c.phrase WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * c.a),
        b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) = 1),
        z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
        SELECT z.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM z JOIN tot USING (lang) WHERE rank <= 2000""",
    "op13_secret_ownership": f"""
        WITH d AS (SELECT doc_id, source, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
        a AS ({_found('assign', 0)} UNION ALL {_found('access', 1)} UNION ALL {_found('hex', 2)}),
        b AS (SELECT *, s + length(m) AS e, CASE WHEN kind = 'assign' THEN regexp_extract(m, '{_SECRETS['assign']}', 2) ELSE m END AS v FROM a
              WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(m, '{_SECRETS['assign']}', 2)) >= 6 WHEN 'access' THEN length(m) >= 20 ELSE length(m) >= 24 END),
        c AS (SELECT *, s + length(m) AS e, m AS v FROM ({_found('owned', 3)})
              WHERE length(regexp_replace(m, '[^0-9]', '', 'g')) >= 3 AND length(regexp_replace(m, '[^A-Za-z]', '', 'g')) >= 3 AND len(list_distinct(string_split(m, ''))) >= 10),
        f AS (SELECT * FROM b UNION ALL SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.doc_id = c.doc_id AND b.s < c.e AND c.s < b.e)),
        k AS (SELECT v, count(DISTINCT source) + max((source IS NULL)::INT) AS owners FROM f GROUP BY 1),
        g AS (SELECT f.*, owners, kind || ':' || s || ':' || e AS x FROM f JOIN k USING (v) WHERE o < 3 OR owners <= 1),
        r AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'owned') AS n_owned,
                     count(*) FILTER (owners > 1) AS n_copied, string_agg(x, ',' ORDER BY s, o) FILTER (o < 3) AS base, string_agg(x, ',' ORDER BY s, o) AS spans FROM g GROUP BY 1)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_owned, 0) AS n_owned, coalesce(n_copied, 0) AS n_copied,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN r USING (doc_id)""",
}
