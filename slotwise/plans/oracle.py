"""DuckDB oracle SQL, one statement per catalogue key.

Written independently of the Spark code, from the reference's semantics:
named CTEs over the fixture views, composed per query. The slot fold is
unrolled as one CTE per slot, each excluding the ids picked before it.
Fixture-specific facts used here: the launch has slots 1–4 of width 2, the
templates name ``traveler.home_city``, ``traveler.nation_key``,
``fx_nation_lookup.label`` bound on ``nation_key`` and ``fx_offer_lookup.offer``
bound on ``nation_key`` and ``first_name``.
"""

from __future__ import annotations

from slotwise.sources import fixtures as fx

SEED = "(week(DATE '2024-03-05') + isodow(DATE '2024-03-05') - 1)"
SLOTS = [1, 2, 3, 4]
WIDTH = 2
KEYS = ["campaign_id", "test_keys", "segment_type_id", "priority", "first_name", "home_city", "nation_key"]
MISSING_RE = "(?i:value_not_found|none|null)|NaN|nan"


def pmod(a: str, n: str) -> str:
    return f"(((({a}) % ({n})) + ({n})) % ({n}))"


def _keys_match(l: str, r: str) -> str:
    return " AND ".join(f"{l}.{k} IS NOT DISTINCT FROM {r}.{k}" for k in KEYS)


def _left_keys(b: str) -> str:
    return (
        f"CASE WHEN {b} IS NULL THEN '' ELSE array_to_string(list_filter(list_transform(string_split(split_part({b}, '|', 1), ';'),"
        f" lambda x: split_part(x, '.', 2)), lambda x: x <> ''), ';') END"
    )


def _right_keys(b: str) -> str:
    return (
        f"CASE WHEN {b} LIKE '%|%' THEN array_to_string(list_transform(string_split(split_part({b}, '|', 2), ';'),"
        f" lambda x: split_part(x, '.', 2)), ';') ELSE '' END"
    )


def token_text(null_text: str) -> str:
    return f"""CASE WHEN split_part(t, '.', 1) = 'traveler' THEN
      CASE split_part(t, '.', 2)
        WHEN 'home_city' THEN CASE WHEN home_city IS NULL THEN '{null_text}' WHEN home_city = '' THEN 'value_not_found' ELSE home_city END
        WHEN 'first_name' THEN CASE WHEN first_name IS NULL THEN '{null_text}' WHEN first_name = '' THEN 'value_not_found' ELSE first_name END
        WHEN 'nation_key' THEN CASE WHEN nation_key IS NULL THEN '{null_text}' WHEN nation_key = '' THEN 'value_not_found' ELSE nation_key END
        ELSE 'value_not_found' END
    WHEN t = 'fx_nation_lookup.label' AND spec = 'nation_key|nation_key' THEN
      CASE WHEN NOT hit OR label = '' THEN 'value_not_found' WHEN label IS NULL THEN '{null_text}' ELSE label END
    WHEN t = 'fx_offer_lookup.offer' AND spec = 'nation_key;first_name|nation_key;segment' THEN
      CASE WHEN NOT hit2 OR offer = '' THEN 'value_not_found' WHEN offer IS NULL THEN '{null_text}' ELSE offer END
    ELSE 'value_not_found' END"""


def _fold_ctes() -> dict[str, tuple[str, list[str]]]:
    out = {}
    prev = "ckeys"
    used: list[str] = []
    for s in SLOTS:
        not_used = f"AND rc.module_id NOT IN ({', '.join('k.' + u for u in used)})" if used else ""
        best = (
            "{'eff': eff, 'type_id': type_id, 'module_id': module_id, 'placement': placement_type, 'dflt': default_flag,"
            " 'att': att_option, " + ", ".join(f"'p{v}': p{v}" for v in range(1, WIDTH + 1)) + "}"
        )
        cands_match = "c.campaign_id = k.campaign_id AND c.test_keys = k.test_keys AND c.segment_type_id = k.segment_type_id"
        out[f"st{s}"] = (
            f"""SELECT k.*,
  EXISTS (SELECT 1 FROM cands c WHERE {cands_match} AND c.slot_position = {s}) AS has_{s},
  (SELECT arg_min({best}, (eff, type_id, module_id)) FROM rc WHERE {_keys_match('rc', 'k')} AND rc.slot_position = {s} {not_used}) AS b_{s}
FROM {prev} k""",
            [prev, "cands", "rc"],
        )
        empty_banner = f"(b_{s}.eff = 9999 AND coalesce(b_{s}.dflt = 0, false) AND b_{s}.placement = 'banner')"
        hero = f"(b_{s}.eff = 9999 AND coalesce(b_{s}.dflt = 0, false) AND b_{s}.placement = 'hero')"

        def label(expr):
            return f"CASE WHEN NOT has_{s} THEN 'dummy' WHEN b_{s} IS NULL THEN 'pixel_module' ELSE {expr} END"

        ps = ",\n  ".join(
            f"CASE WHEN NOT has_{s} OR b_{s} IS NULL OR {empty_banner} THEN 'None' ELSE b_{s}.p{v} END AS p{v}_{s}" for v in range(1, WIDTH + 1)
        )
        out[f"sel{s}"] = (
            f"""SELECT *,
  CASE WHEN NOT has_{s} OR b_{s} IS NULL OR {empty_banner} THEN 999 ELSE b_{s}.module_id END AS m_{s},
  {label(f"CAST(b_{s}.eff AS VARCHAR)")} AS pr_{s},
  {label(f"CAST(b_{s}.type_id AS VARCHAR)")} AS ty_{s},
  {label(f"b_{s}.att")} AS at_{s},
  {ps},
  coalesce(has_{s} AND b_{s} IS NOT NULL AND {hero}, false) AS h_{s}
FROM st{s}""",
            [f"st{s}"],
        )
        prev = f"sel{s}"
        used.append(f"m_{s}")
    cols = []
    for s in SLOTS:
        cols += [f"p{v}_{s} AS S{s}_P{v}" for v in range(1, WIDTH + 1)]
        cols += [f"pr_{s} AS S{s}_module_priority", f"m_{s} AS S{s}_module_id", f"at_{s} AS S{s}_att_option", f"ty_{s} AS S{s}_module_type_id"]
    trace = " || '_' || ".join(f"'{s}.' || CAST(m_{s} AS VARCHAR)" for s in SLOTS)
    hero_any = " OR ".join(f"h_{s}" for s in SLOTS)
    out["rendered"] = (
        f"""SELECT {', '.join(KEYS)}, {', '.join(cols)},
  {trace} AS OmniExtension, replace({trace}, '.', '-') AS OmniExtNewFormat,
  CASE WHEN {hero_any} THEN greatest(CAST(priority AS INT), 9999) ELSE CAST(priority AS INT) END AS campaign_priority
FROM {prev}""",
        [prev],
    )
    return out


def _string_cols() -> list[str]:
    cols = ["email_address", "first_name", "last_name", "locale"]
    for s in SLOTS:
        cols += [f"S{s}_P{v}" for v in range(1, WIDTH + 1)] + [f"S{s}_module_priority", f"S{s}_att_option", f"S{s}_module_type_id"]
    return cols + ["OmniExtension", "OmniExtNewFormat", "UserToken", "AudienceTableName"]


def build_ctes(strict: bool = False, seeds_per_campaign: bool = True) -> dict[str, tuple[str, list[str]]]:
    """The CTE library; ``strict`` = strict empty-content test, ``seeds_per_campaign``
    = seed addresses keep one row per campaign in the dedupe (Q10)."""
    tt = token_text("value_not_found" if strict else "None")
    missing = "coalesce(contains(v0, 'value_not_found') OR v0 = 'None', false)" if strict else f"coalesce(regexp_matches(v0, '{MISSING_RE}'), false)"
    dedupe_part = "email_address, paid, _seed_campaign" if seeds_per_campaign else "email_address, paid"
    return _ctes(tt, missing, dedupe_part)


def _ctes(tt: str, missing: str, dedupe_part: str) -> dict[str, tuple[str, list[str]]]:
    return {
        "mv": (
            """SELECT m.* EXCLUDE (var_source, locale), lower(m.locale) AS locale, COALESCE(b.vs, NULLIF(m.var_source, '')) AS var_source
    FROM fx_module_vars m
    LEFT JOIN (SELECT DISTINCT module_id, source_connection, var_source AS vs FROM fx_module_vars WHERE var_source <> '') b
      ON m.module_id = b.module_id AND m.source_connection = b.source_connection
    WHERE lower(m.locale) = 'en_us' AND m.tpid = 1 AND m.eapid = 0""",
            ["fx_module_vars"],
        ),
        "camp": (
            """SELECT * REPLACE (lower(locale) AS locale) FROM fx_campaigns
    WHERE lower(locale) = 'en_us' AND LaunchDate = '2024-03-05' AND tpid = 1 AND eapid = 0 AND campaign_deleted_flag = 0""",
            ["fx_campaigns"],
        ),
        "meta": (
            """SELECT * EXCLUDE (status) FROM camp
    JOIN (SELECT * FROM fx_templates WHERE template_deleted_flag = 0) USING (template_id)
    JOIN (SELECT * FROM fx_segment_modules WHERE seg_mod_deleted_flag = 0) USING (segment_module_map_id)
    JOIN (SELECT * REPLACE (lower(locale) AS locale) FROM fx_modules) USING (locale, module_type_id, tpid, eapid, placement_type, channel)
    JOIN (SELECT * FROM fx_segment_defs WHERE segment_deleted_flag = 0) USING (tpid, eapid, segment_type_id)
    WHERE status = 'active published'""",
            ["camp", "fx_templates", "fx_segment_modules", "fx_modules", "fx_segment_defs"],
        ),
        "vc": (
            """SELECT DISTINCT m.campaign_id, m.slot_position, m.module_type_id, m.placement_type, t.ttl_versions
    FROM meta m JOIN (SELECT module_type_id, placement_type, count(DISTINCT version) AS ttl_versions FROM meta GROUP BY module_type_id, placement_type) t
      ON m.module_type_id = t.module_type_id AND m.placement_type = t.placement_type""",
            ["meta"],
        ),
        "content": (
            """SELECT * EXCLUDE (version, locale),
      CAST(dense_rank() OVER (PARTITION BY campaign_id, slot_position, module_type_id, placement_type ORDER BY version) AS INT) AS version
    FROM meta LEFT JOIN mv USING (module_id, tpid, eapid, locale) JOIN vc USING (campaign_id, slot_position, module_type_id, placement_type)""",
            ["meta", "mv", "vc"],
        ),
        "seg": (
            """SELECT email_address, test_keys, tpid, eapid, lower(locale) AS locale, segment_type_id AS campaign_segment_type_id,
      segment_type_id_concat AS segment_type_id FROM fx_segments""",
            ["fx_segments"],
        ),
        "lc": ("SELECT DISTINCT campaign_segment_type_id, campaign_id, priority, tpid, eapid, locale FROM meta", ["meta"]),
        "assigned": ("SELECT * FROM seg JOIN lc USING (campaign_segment_type_id, tpid, eapid, locale)", ["seg", "lc"]),
        "prof": ("SELECT * REPLACE (lower(locale) AS locale) FROM fx_profiles WHERE mer_status = 1", ["fx_profiles"]),
        "audience": ("SELECT DISTINCT * EXCLUDE (profile_note) FROM assigned JOIN prof USING (email_address, test_keys, tpid, eapid, locale)", ["assigned", "prof"]),
        "cohorts": ("SELECT DISTINCT campaign_id, test_keys, segment_type_id FROM audience", ["audience"]),
        "ckeys": (f"SELECT DISTINCT {', '.join(KEYS)} FROM audience", ["audience"]),
        "offered": (
            """SELECT DISTINCT campaign_id, slot_position, segment_type_id AS seg, module_type_id, placement_type,
      CAST(module_priority_in_slot AS INT) AS module_priority_in_slot, CAST(module_id AS INT) AS module_id, version, ttl_versions
    FROM content WHERE var_position IS NOT NULL""",
            ["content"],
        ),
        "members": (
            "SELECT DISTINCT campaign_id, test_keys, segment_type_id, CAST(unnest(string_split(segment_type_id, '#')) AS INT) AS seg FROM cohorts",
            ["cohorts"],
        ),
        "cands": (
            f"""SELECT mb.campaign_id, mb.test_keys, mb.segment_type_id, o.slot_position, o.module_type_id, o.module_priority_in_slot,
      max(o.module_id) AS module_id
    FROM members mb JOIN offered o ON mb.campaign_id = o.campaign_id AND mb.seg = o.seg
    WHERE o.version = {pmod('mb.test_keys + ' + pmod(SEED, 'o.ttl_versions'), 'o.ttl_versions')} + 1
    GROUP BY mb.campaign_id, mb.test_keys, mb.segment_type_id, o.slot_position, o.module_type_id, o.module_priority_in_slot""",
            ["members", "offered"],
        ),
        "modattr": (
            """SELECT CAST(module_id AS INT) AS module_id, max(placement_type) AS placement_type, max(module_type) AS module_type,
      max(CAST("default" AS INT)) AS default_flag FROM content GROUP BY 1""",
            ["content"],
        ),
        "modvars": (
            f"""SELECT *, regexp_extract_all(coalesce(template, ''), '(?s)%%(.*?)%%', 1) AS tokens,
      {_left_keys('binding')} || '|' || {_right_keys('binding')} AS spec
    FROM (SELECT CAST(module_id AS INT) AS module_id, CAST(var_position AS INT) AS pos, var_source AS binding, max(var_structure) AS template
          FROM content WHERE var_position IS NOT NULL GROUP BY 1, 2, 3)""",
            ["content"],
        ),
        "lkp": (
            """SELECT CAST(nation_key AS VARCHAR) AS k, max(label) AS label FROM fx_nation_lookup
    WHERE lower(locale) = 'en_us' AND tpid = 1 AND eapid = 0 GROUP BY 1""",
            ["fx_nation_lookup"],
        ),
        "lkp2": (
            """SELECT CAST(nation_key AS VARCHAR) AS k1, CAST(segment AS VARCHAR) AS k2, max(offer) AS offer FROM fx_offer_lookup
    WHERE lower(locale) = 'en_us' AND tpid = 1 AND eapid = 0 GROUP BY 1, 2""",
            ["fx_offer_lookup"],
        ),
        "kv": (
            """SELECT k.*, l.k IS NOT NULL AS hit, l.label, o.k1 IS NOT NULL AS hit2, o.offer FROM ckeys k
    LEFT JOIN lkp l ON CAST(k.nation_key AS VARCHAR) = l.k
    LEFT JOIN lkp2 o ON CAST(k.nation_key AS VARCHAR) = o.k1 AND CAST(k.first_name AS VARCHAR) = o.k2""",
            ["ckeys", "lkp", "lkp2"],
        ),
        "cv": (
            f"""SELECT kv.*, c.slot_position, c.module_type_id AS type_id, c.module_priority_in_slot AS cpriority, c.module_id,
      a.placement_type, a.default_flag, v.pos, v.binding, v.template, v.tokens, v.spec,
      (c.slot_position = 1 AND v.pos = 1) AS is_first,
      replace(list_reduce(v.tokens, lambda acc, t: replace(acc, t, {tt}), coalesce(v.template, '')), '%%', '') AS text
    FROM kv JOIN cands c USING (campaign_id, test_keys, segment_type_id)
    JOIN modattr a ON a.module_id = c.module_id
    JOIN modvars v ON v.module_id = c.module_id""",
            ["kv", "cands", "modattr", "modvars"],
        ),
        "cr": (
            f"""SELECT *, CASE WHEN n > 2 THEN parts[idx + 2] WHEN n = 2 THEN parts[2] WHEN is_first THEN parts[1] ELSE 'None' END AS v0,
      CASE WHEN n > 2 THEN CAST(idx AS VARCHAR) WHEN n = 2 THEN '0' ELSE 'default' END AS a0
    FROM (SELECT *, CASE WHEN n > 2 THEN {pmod('test_keys + ' + pmod(SEED, 'n - 1'), 'n - 1')} END AS idx
          FROM (SELECT *, string_split(text, '|') AS parts, len(string_split(text, '|')) AS n FROM cv))""",
            ["cv"],
        ),
        "rv": (
            f"""SELECT *, CASE WHEN missing THEN (CASE WHEN is_first THEN parts[1] ELSE 'None' END) ELSE v0 END AS value,
      CASE WHEN missing THEN 'default' ELSE a0 END AS att
    FROM (SELECT *, {missing} AS missing FROM cr)""",
            ["cr"],
        ),
        "rc": (
            f"""SELECT {', '.join(KEYS)}, slot_position, module_id, type_id, cpriority, placement_type, default_flag,
      CASE WHEN bool_or(missing) AND placement_type IN ('hero', 'banner') AND coalesce(default_flag = 0, false) THEN 9999 ELSE cpriority END AS eff,
      string_agg('#S' || slot_position || '_P' || pos || '.' || att, '' ORDER BY pos, binding NULLS FIRST) AS att_option,
      {', '.join(f"coalesce(max(value) FILTER (WHERE pos = {v}), '') AS p{v}" for v in range(1, WIDTH + 1))}
    FROM rv GROUP BY {', '.join(KEYS)}, slot_position, module_id, type_id, cpriority, placement_type, default_flag""",
            ["rv"],
        ),
        **_fold_ctes(),
        "launch": ("SELECT DISTINCT campaign_id, locale, LaunchDateTimeUTC FROM camp", ["camp"]),
        "personalised": (
            f"""SELECT a.tpid, a.eapid, a.email_address, a.expuserid, a.first_name, a.mer_status, a.lang_id, a.last_name, a.locale, a.paid,
      a.test_keys, a.campaign_id, r.* EXCLUDE ({', '.join(KEYS)}), {len(SLOTS)} AS ModuleCount, l.LaunchDateTimeUTC
    FROM audience a JOIN rendered r ON {_keys_match('a', 'r')}
    JOIN launch l ON l.campaign_id = a.campaign_id AND l.locale = a.locale""",
            ["audience", "rendered", "launch"],
        ),
        "best": (
            """SELECT * EXCLUDE (campaign_id, rk), CAST(campaign_id AS INT) AS campaign_id
    FROM (SELECT *, rank() OVER (PARTITION BY email_address ORDER BY campaign_priority) AS rk FROM personalised)
    WHERE rk = 1 AND campaign_priority <> 9999 AND S1_module_id <> 999 AND S2_module_id <> 999""",
            ["personalised"],
        ),
        "tok": (
            """SELECT b.*, coalesce('emailclick/' || atk.UserToken || '/', 'emailclick/' || stk.UserToken || '/', '') AS UserToken
    FROM best b LEFT JOIN fx_account_tokens atk ON b.paid = atk.ProtoAccountID
    LEFT JOIN fx_subscriber_tokens stk ON b.paid = stk.SubscriberID
    WHERE b.paid IS NOT NULL""",
            ["best", "fx_account_tokens", "fx_subscriber_tokens"],
        ),
        "seeds": (
            """SELECT *, CAST(row_number() OVER (ORDER BY SeedEmail) AS INT) AS row_id
    FROM (SELECT DISTINCT tpid, eapid, lower(locale) AS locale, SeedEmail FROM fx_seeds
          WHERE CampaignCategory = 'Merch' AND IsActive = 1 AND lower(locale) = 'en_us' AND tpid = 1 AND eapid = 0)""",
            ["fx_seeds"],
        ),
        "sample": (
            """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY campaign_id ORDER BY test_keys, email_address) AS INT) AS row_id FROM tok)
    WHERE row_id <= (SELECT count(*) FROM seeds)""",
            ["tok", "seeds"],
        ),
        "seedrows": (
            """SELECT s.* EXCLUDE (email_address, paid, row_id), sd.SeedEmail AS email_address, 999999999 AS paid
    FROM sample s JOIN seeds sd ON s.tpid = sd.tpid AND s.eapid = sd.eapid AND s.locale = sd.locale AND s.row_id = sd.row_id""",
            ["sample", "seeds"],
        ),
        "appended": (
            """SELECT *, CAST(NULL AS INT) AS _seed_campaign FROM tok
    UNION ALL BY NAME
    SELECT *, campaign_id AS _seed_campaign FROM seedrows""",
            ["tok", "seedrows"],
        ),
        "mcount": (
            "SELECT campaign_id, AudienceTableName, count(DISTINCT slot_position) AS ModuleCount FROM content GROUP BY campaign_id, AudienceTableName",
            ["content"],
        ),
        "deduped": (
            f"""SELECT * EXCLUDE (_rn, _seed_campaign) FROM (
      SELECT *, row_number() OVER (PARTITION BY {dedupe_part}
        ORDER BY campaign_priority ASC NULLS LAST, campaign_id ASC NULLS LAST, AudienceTableName ASC NULLS LAST) AS _rn
      FROM (SELECT a.* EXCLUDE (ModuleCount), m.AudienceTableName, m.ModuleCount FROM appended a JOIN mcount m ON a.campaign_id = CAST(m.campaign_id AS INT)))
    WHERE _rn = 1""",
            ["appended", "mcount"],
        ),
        "nl": (
            "SELECT * REPLACE (" + ", ".join(f"NULLIF({c}, 'None') AS {c}" for c in _string_cols()) + ") FROM deduped",
            ["deduped"],
        ),
        "final": (
            """SELECT n.* EXCLUDE (tpid, eapid, first_name, last_name, lang_id, mer_status, paid, email_address, AudienceTableName, campaign_priority),
      n.tpid AS TPID, n.eapid AS EAPID, n.first_name AS FIRST_NAME, n.last_name AS LAST_NAME, n.lang_id AS LANG_ID, n.mer_status AS IsMER,
      n.paid AS PAID, n.email_address AS EmailAddress, n.S1_P1 AS SubjectLine, n.mer_status AS PM_OK_IND,
      m.MemberID AS LoyaltyMemberID, m.LRMTierName AS LoyaltyMemberTierName, m.MonetaryValue, m.LRMAvailablePoints AS LoyaltyAvailablePoints,
      CASE WHEN m.LRMStatus = 'Active' THEN '1' ELSE '0' END AS LoyaltyMemberStatus
    FROM nl n LEFT JOIN fx_members m ON n.tpid = m.TPID AND n.paid = m.PAID""",
            ["nl", "fx_members"],
        ),
        "req": (
            f"""SELECT DISTINCT split_part(t, '.', 1) AS table_name, left_keys, right_keys, split_part(t, '.', 2) AS column_name,
      left_keys || '|' || right_keys AS spec
    FROM (SELECT {_left_keys('var_source')} AS left_keys, {_right_keys('var_source')} AS right_keys,
            unnest(regexp_extract_all(coalesce(var_structure, ''), '(?s)%%(.*?)%%', 1)) AS t
          FROM (SELECT DISTINCT var_source, var_structure FROM content WHERE var_position IS NOT NULL AND var_source LIKE '%|%'))
    WHERE split_part(t, '.', 1) <> 'traveler'""",
            ["content"],
        ),
    }


CTES = build_ctes()


def compose(names: list[str], body: str, ctes: dict | None = None) -> str:
    """``WITH`` clause holding every CTE the body needs, in dependency order."""
    ctes = ctes or CTES
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        if n in fx.FIXTURE_SQL:
            order.append(n)
            return
        sql, deps = ctes[n]
        for d in deps:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        sql = fx.duckdb_text(n) if n in fx.FIXTURE_SQL else ctes[n][0]
        parts.append(f"{n} AS (\n{sql}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + body


def _cv_choose() -> str:
    parts = "string_split(coalesce(var_structure, ''), '|')"
    n = f"len({parts})"
    idx = pmod("module_id + " + pmod(SEED, f"{n} - 1"), f"{n} - 1")
    return f"""SELECT module_id, var_position, var_structure,
  CASE WHEN {n} > 2 THEN {parts}[{idx} + 2] WHEN {n} = 2 THEN {parts}[2] WHEN var_position = 1 THEN {parts}[1] ELSE 'None' END AS value,
  CASE WHEN {n} > 2 THEN CAST({idx} AS VARCHAR) WHEN {n} = 2 THEN '0' ELSE 'default' END AS att
FROM (SELECT DISTINCT module_id, var_position, var_structure FROM content)"""


ORACLE: dict[str, str] = {
    "scan_table": "SELECT * FROM customer",
    "load_config": compose(
        ["fx_campaigns", "fx_templates", "fx_segment_modules", "fx_module_vars", "fx_segment_defs", "fx_modules"],
        """SELECT 'campaign_definition' AS table_name, count(*) AS row_count, 12 AS column_count FROM fx_campaigns
UNION ALL SELECT 'template_definition', count(*), 2 FROM fx_templates
UNION ALL SELECT 'segment_module', count(*), 8 FROM fx_segment_modules
UNION ALL SELECT 'module_variable_definition', count(*), 8 FROM fx_module_vars
UNION ALL SELECT 'segment_definition', count(*), 4 FROM fx_segment_defs
UNION ALL SELECT 'module_definition', count(*), 11 FROM fx_modules""",
    ),
    "active_profiles": compose(["prof"], "SELECT * FROM prof"),
    "read_segments": compose(["fx_segments"], "SELECT * FROM fx_segments"),
    "latest_schedule": compose(
        ["fx_schedules"],
        "SELECT * FROM fx_schedules WHERE Locale = 'en_us' AND IsFinal = 1 AND NOT (Job_Name LIKE ' ') ORDER BY ScheduleTimes DESC, ID DESC LIMIT 1",
    ),
    "latest_run": compose(
        ["fx_run_log"],
        "SELECT LogID, FilePath FROM fx_run_log WHERE SourceID = 7 AND IsComplete = 1 AND SourceName = 'ETL' ORDER BY StartDate DESC, LogID DESC LIMIT 1",
    ),
    "latest_run_all": compose(
        ["fx_run_log"],
        """SELECT SourceID, SourceName, arg_max(LogID, (EndDate, LogID)) AS LogID, arg_max(FilePath, (EndDate, LogID)) AS FilePath
FROM fx_run_log WHERE IsComplete = 1 GROUP BY SourceID, SourceName""",
    ),
    "process_identity": compose(
        ["fx_process_config"], "SELECT id, ProcessName FROM fx_process_config WHERE Locale = 'en_US' AND brand LIKE 'Brand A' ORDER BY id LIMIT 1"
    ),
    "required_lookups": compose(["req"], "SELECT * FROM req"),
    "missing_lookups": compose(
        ["req"],
        """SELECT DISTINCT table_name, CASE WHEN table_name = 'fx_nation_lookup' THEN column_name ELSE '*' END AS column_name
FROM req WHERE table_name <> 'fx_nation_lookup' OR column_name NOT IN ('locale', 'tpid', 'eapid', 'nation_key')""",
    ),
    "normalize_locale": compose(["fx_module_vars"], "SELECT * REPLACE (lower(locale) AS locale) FROM fx_module_vars"),
    "derive_scope": compose(
        ["fx_profiles"],
        "SELECT DISTINCT lower(locale) AS locale, tpid, eapid FROM fx_profiles WHERE locale IS NOT NULL AND tpid IS NOT NULL AND eapid IS NOT NULL",
    ),
    "in_scope": compose(
        ["fx_nation_lookup"],
        "SELECT * REPLACE (lower(locale) AS locale) FROM fx_nation_lookup WHERE lower(locale) = 'en_us' AND tpid = 1 AND eapid = 0",
    ),
    "launching_campaigns": compose(
        ["fx_campaigns"], "SELECT * REPLACE (lower(locale) AS locale) FROM fx_campaigns WHERE lower(locale) = 'en_us' AND LaunchDate = '2024-03-05'"
    ),
    "backfill_binding": compose(["mv"], "SELECT * FROM mv"),
    "null_literals": compose(["nl"], "SELECT * FROM nl"),
    "campaign_meta": compose(["meta"], "SELECT * FROM meta"),
    "campaign_expanded": compose(["content"], "SELECT * FROM content"),
    "version_counts": compose(["vc"], "SELECT * FROM vc"),
    "version_rank": compose(
        ["content"], "SELECT DISTINCT campaign_id, slot_position, module_type_id, placement_type, module_id, version FROM content"
    ),
    "slot_widths": compose(["content"], "SELECT slot_position, max(var_position) AS var_position FROM content GROUP BY slot_position"),
    "slot_list": compose(
        ["content"],
        """SELECT CAST(count(DISTINCT slot_position) AS INT) AS number_slots,
  coalesce(array_to_string(list_sort(list_distinct(list(slot_position))), ','), '') AS slots
FROM content WHERE var_position IS NOT NULL""",
    ),
    "module_count": compose(["mcount"], "SELECT * FROM mcount"),
    "assign_campaigns": compose(["assigned"], "SELECT DISTINCT * FROM assigned"),
    "audience": compose(["audience"], "SELECT * FROM audience"),
    "cohorts": compose(["cohorts"], "SELECT * FROM cohorts"),
    "segment_members": compose(
        ["cohorts"], "SELECT c.*, CAST(s AS INT) AS segment_id FROM cohorts c, unnest(list_distinct(string_split(c.segment_type_id, '#'))) t(s)"
    ),
    "content_keys": compose(["ckeys"], "SELECT * FROM ckeys"),
    "parse_binding": compose(
        ["content"],
        f"""SELECT var_source,
  CASE WHEN var_source LIKE '%|%' THEN split_part(split_part(split_part(var_source, '|', 2), ';', 1), '.', 1) END AS table_name,
  {_left_keys('var_source')} AS left_keys, {_right_keys('var_source')} AS right_keys
FROM (SELECT DISTINCT var_source FROM content)""",
    ),
    "template_tokens": compose(
        ["content"],
        """SELECT var_structure, array_to_string(regexp_extract_all(coalesce(var_structure, ''), '(?s)%%(.*?)%%', 1), ',') AS tokens
FROM (SELECT DISTINCT var_structure FROM content)""",
    ),
    # A piece of plain text starts a new option at each separator in it; a token continues the one before.
    "template_segments": compose(
        ["content"],
        """SELECT var_structure, CAST(option_no AS INT) AS option_no,
      CAST(row_number() OVER (PARTITION BY var_structure, option_no ORDER BY i, j) - 1 AS INT) AS segment_no,
      CASE WHEN is_token THEN NULL ELSE part END AS literal, CASE WHEN is_token THEN part END AS token
    FROM (SELECT var_structure, i, j, is_token, part, sum(CASE WHEN j > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY var_structure ORDER BY i, j) AS option_no
      FROM (SELECT var_structure, i, is_token, unnest(generate_series(1, len(parts))) AS j, unnest(parts) AS part
        FROM (SELECT var_structure, i, string_split(pieces[i], '|') AS parts,
                i % 2 = 0 AND i < len(pieces) AND NOT contains(pieces[i], '|') AS is_token
          FROM (SELECT var_structure, pieces, unnest(generate_series(1, len(pieces))) AS i
            FROM (SELECT DISTINCT var_structure, string_split(coalesce(var_structure, ''), '%%') AS pieces FROM content)))))""",
    ),
    "choose_option": compose(["content"], _cv_choose()),
    "version_choice": compose(
        ["cohorts", "vc"],
        f"""SELECT c.campaign_id, c.test_keys, v.slot_position, v.module_type_id, v.placement_type, v.ttl_versions,
  {pmod('c.test_keys + ' + pmod(SEED, 'v.ttl_versions'), 'v.ttl_versions')} + 1 AS version
FROM (SELECT DISTINCT campaign_id, test_keys FROM cohorts) c JOIN vc v ON c.campaign_id = v.campaign_id""",
    ),
    "rotation_seed": compose(
        ["fx_run_log"],
        "SELECT strftime(day, '%Y-%m-%d') AS day, CAST(week(day) + isodow(day) - 1 AS INT) AS seed FROM (SELECT DISTINCT CAST(StartDate AS DATE) AS day FROM fx_run_log)",
    ),
    "missing_content": compose(
        ["fx_nation_lookup"],
        f"""SELECT nation_key, label, coalesce(regexp_matches(label, '{MISSING_RE}'), false) AS missing_compat,
  coalesce(contains(label, 'value_not_found') OR label = 'None', false) AS missing_strict FROM fx_nation_lookup""",
    ),
    "locale_parts": compose(
        ["fx_profiles"],
        """SELECT locale, split_part(locale, '_', 1) AS language, upper(split_part(locale, '_', 2)) AS country,
  split_part(locale, '_', 1) || '_' || upper(split_part(locale, '_', 2)) AS display FROM (SELECT DISTINCT locale FROM fx_profiles)""",
    ),
    "dated_path": compose(
        ["fx_run_log"],
        "SELECT strftime(day, '%Y-%m-%d') AS day, '/out/config/' || strftime(day, '%Y/%m/%d') AS path FROM (SELECT DISTINCT CAST(StartDate AS DATE) AS day FROM fx_run_log)",
    ),
    "module_candidates": compose(["cands"], "SELECT * FROM cands"),
    "module_variables": compose(
        ["modvars"],
        """SELECT module_id, CAST(row_number() OVER (PARTITION BY module_id ORDER BY pos, binding NULLS FIRST, template NULLS FIRST) - 1 AS INT) AS i,
  pos, binding, template, array_to_string(tokens, ',') AS tokens, spec FROM modvars""",
    ),
    "lookup_values": compose(
        ["kv"],
        f"""SELECT {', '.join(KEYS)}, 'traveler.home_city' AS value_key, home_city AS value FROM kv
UNION ALL SELECT {', '.join(KEYS)}, 'traveler.first_name', first_name FROM kv
UNION ALL SELECT {', '.join(KEYS)}, 'traveler.nation_key', nation_key FROM kv
UNION ALL SELECT {', '.join(KEYS)}, 'fx_offer_lookup.offer@nation_key;first_name|nation_key;segment', offer FROM kv WHERE hit2
UNION ALL SELECT {', '.join(KEYS)}, 'fx_nation_lookup.label@nation_key|nation_key', label FROM kv WHERE hit""",
    ),
    "demoted_modules": compose(["rc"], f"SELECT {', '.join(KEYS)}, slot_position, module_id, eff AS effective_priority, att_option FROM rc"),
    "rendered_content": compose(["rv"], f"SELECT {', '.join(KEYS)}, slot_position, module_id, pos AS var_position, value FROM rv"),
    "slot_choice": compose(["rendered"], "SELECT * EXCLUDE (OmniExtension, OmniExtNewFormat) FROM rendered"),
    "module_trace": compose(["rendered"], f"SELECT {', '.join(KEYS)}, OmniExtension, OmniExtNewFormat FROM rendered"),
    "personalised": compose(["personalised"], "SELECT * FROM personalised"),
    "best_campaign": compose(["best"], "SELECT * FROM best"),
    "with_tokens": compose(["tok"], "SELECT * FROM tok"),
    "campaign_sample": compose(["sample"], "SELECT * FROM sample"),
    "seed_rows": compose(["seedrows"], "SELECT * FROM seedrows"),
    "append_seeds": compose(["appended"], "SELECT * EXCLUDE (_seed_campaign) FROM appended"),
    "dedupe_recipients": compose(["deduped"], "SELECT * FROM deduped"),
    "loyalty_join": compose(
        ["nl", "fx_members"],
        """SELECT n.tpid AS TPID, n.paid AS PAID, n.email_address AS EmailAddress, n.campaign_id,
  m.MemberID AS LoyaltyMemberID, m.LRMTierName AS LoyaltyMemberTierName, m.MonetaryValue, m.LRMAvailablePoints AS LoyaltyAvailablePoints,
  m.LRMStatus, m.authrealm_code, CASE WHEN m.LRMStatus = 'Active' THEN '1' ELSE '0' END AS LoyaltyMemberStatus
FROM nl n LEFT JOIN fx_members m ON n.tpid = m.TPID AND n.paid = m.PAID""",
    ),
    "output_contract": compose(["final"], "SELECT * FROM final"),
    "gate_counts": compose(
        ["mv", "meta", "vc", "content", "audience", "cohorts", "cands", "modvars"],
        """SELECT 'module variables' AS stage, (SELECT count(*) FROM mv) AS row_count
UNION ALL SELECT 'campaign metadata', (SELECT count(*) FROM meta)
UNION ALL SELECT 'version counts', (SELECT count(*) FROM vc)
UNION ALL SELECT 'expanded content', (SELECT count(*) FROM content)
UNION ALL SELECT 'audience', (SELECT count(*) FROM audience)
UNION ALL SELECT 'cohorts', (SELECT count(*) FROM cohorts)
UNION ALL SELECT 'allocation', (SELECT count(*) FROM (SELECT DISTINCT campaign_id, test_keys, segment_type_id FROM cands c
  WHERE EXISTS (SELECT 1 FROM modvars v WHERE v.module_id = c.module_id)))
UNION ALL SELECT 'module content', (SELECT count(DISTINCT module_id) FROM modvars)""",
    ),
    "backfill_binding_compat": compose(
        ["fx_module_vars"],
        """SELECT m.* EXCLUDE (var_source), b.vs AS var_source FROM fx_module_vars m
LEFT JOIN (SELECT module_id, source_connection, var_source AS vs FROM fx_module_vars WHERE var_source <> '') b
  ON m.module_id = b.module_id AND m.source_connection = b.source_connection""",
    ),
    "log_times": compose(
        ["fx_run_log"],
        """SELECT LogID, strftime(StartDate AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d %H:%M:%S') AS StartDate,
  strftime(EndDate AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d %H:%M:%S') AS EndDate FROM fx_run_log""",
    ),
}
ORACLE["flagship"] = ORACLE["output_contract"]
ORACLE["lookup_values_filtered"] = ORACLE["lookup_values"]
ORACLE["manifest"] = compose(
    ["final"], "SELECT '/runs/en_us-2024-03-05/*' AS path, 'en_us-2024-03-05' AS run_id, count(*) AS row_count FROM final"
)
ORACLE["run_steps"] = compose(
    ["mv", "meta", "vc", "content", "audience", "cohorts", "cands", "modvars", "final"],
    """SELECT Status, 1 AS IsComplete, row_count, 'campaign run' AS SourceName, 7 AS SourceID FROM (
      SELECT 'launch layout' AS Status, 0 AS row_count
      UNION ALL SELECT 'module variables', count(*) FROM mv
      UNION ALL SELECT 'campaign metadata', count(*) FROM meta
      UNION ALL SELECT 'version counts', count(*) FROM vc
      UNION ALL SELECT 'expanded content', count(*) FROM content
      UNION ALL SELECT 'audience', count(*) FROM audience
      UNION ALL SELECT 'cohorts', count(*) FROM cohorts
      UNION ALL SELECT 'allocation', count(DISTINCT (campaign_id, test_keys, segment_type_id)) FROM cands
      UNION ALL SELECT 'module content', count(DISTINCT module_id) FROM modvars
      UNION ALL SELECT 'plan output', 0
      UNION ALL SELECT 'write output', count(*) FROM final
      UNION ALL SELECT 'publish', 0)""",
)
ORACLE["token_table"] = """SELECT scope, min(name) AS UserTokenTableName FROM (
  SELECT CASE WHEN r_regionkey % 2 = 0 THEN 'en_us' ELSE 'fr_fr' END || ' 1 ' || CASE WHEN r_regionkey >= 2 THEN 1 ELSE 0 END AS scope,
    'tokens_' || r_regionkey AS name FROM region) WHERE scope IN ('en_us 1 0', 'fr_fr 1 1') GROUP BY scope"""
ORACLE["read_ranges"] = compose(["fx_run_log"], "SELECT 8 AS n_ranges, count(*) AS row_count, true AS balanced FROM fx_run_log")
_AS_OF = """(SELECT DISTINCT date_trunc('month', StartDate) AS as_of FROM fx_run_log) d
    JOIN (SELECT * FROM fx_run_log WHERE IsComplete = 1) r ON r.EndDate <= d.as_of"""
ORACLE["runs_as_of"] = compose(
    ["fx_run_log"],
    f"""SELECT strftime(as_of, '%Y-%m-%d') AS as_of, SourceID, SourceName, LogID, FilePath FROM (
      SELECT d.as_of, r.*, row_number() OVER (PARTITION BY d.as_of, SourceID, SourceName ORDER BY EndDate DESC, LogID DESC) AS k FROM {_AS_OF}) WHERE k = 1""",
)
ORACLE["scheduled_runs_as_of"] = compose(
    ["fx_run_log", "fx_schedules"],
    f"""SELECT Locale, ID, strftime(as_of, '%Y-%m-%d') AS as_of, LogID, FilePath FROM (
      SELECT Locale, s.ID, d.as_of, LogID, FilePath, row_number() OVER (PARTITION BY Locale, d.as_of ORDER BY StartDate DESC, LogID DESC) AS k
      FROM {_AS_OF} JOIN (SELECT Locale, ID, row_number() OVER (PARTITION BY Locale ORDER BY ScheduleTimes DESC, ID DESC) AS n
        FROM (SELECT * REPLACE (ID % 20 AS ID) FROM fx_schedules) WHERE IsFinal = 1 AND Job_Name NOT LIKE ' ') s
        ON n = 1 AND s.ID = r.SourceID AND r.SourceName = 'ETL') WHERE k = 1""",
)
# Planted faults as in the query; relations in the order of the expansion.
ORACLE["config_violations"] = compose(
    ["fx_campaigns", "fx_templates", "fx_segment_modules", "fx_modules", "fx_segment_defs", "fx_module_vars"],
    """, ca AS (SELECT * REPLACE (CASE WHEN CAST(campaign_id AS INT) % 7 = 0 THEN template_id + 100 ELSE template_id END AS template_id)
      FROM fx_campaigns WHERE lower(locale) = 'en_us' AND tpid = 1 AND eapid = 0 AND campaign_deleted_flag = 0),
    te AS (SELECT * FROM fx_templates WHERE template_deleted_flag = 0 UNION ALL SELECT * FROM fx_templates WHERE template_deleted_flag = 0 AND template_id <= 2),
    sl AS (SELECT * EXCLUDE (seg_mod_deleted_flag) FROM fx_segment_modules WHERE seg_mod_deleted_flag = 0),
    mo AS (SELECT * FROM fx_modules WHERE lower(locale) = 'en_us' AND tpid = 1 AND eapid = 0 AND module_id % 10 <> 3),
    se AS (SELECT * FROM fx_segment_defs WHERE segment_deleted_flag = 0 AND tpid = 1 AND eapid = 0),
    va AS (SELECT * FROM fx_module_vars WHERE lower(locale) = 'en_us' AND tpid = 1 AND eapid = 0),
    defs AS (
      SELECT 'campaign' AS relation, campaign_id AS key, true AS u FROM ca
      UNION ALL SELECT 'template', CAST(template_id AS VARCHAR), true FROM te
      UNION ALL SELECT 'slot row', concat_ws('|', segment_module_map_id, slot_position, placement_type, module_type_id, channel, segment_type_id, module_priority_in_slot), true FROM sl
      UNION ALL SELECT 'slot map', CAST(segment_module_map_id AS VARCHAR), false FROM sl
      UNION ALL SELECT 'module', CAST(module_id AS VARCHAR), true FROM mo
      UNION ALL SELECT 'module kind', 'en_us|' || module_type_id || '|1|0|' || placement_type || '|' || channel, false FROM mo
      UNION ALL SELECT 'segment', '1|0|' || segment_type_id, true FROM se
      UNION ALL SELECT 'variable', module_id || '|' || var_position || '|' || source_connection, true FROM va),
    refs AS (
      SELECT 'template' AS relation, CAST(template_id AS VARCHAR) AS key FROM ca
      UNION ALL SELECT 'slot map', CAST(segment_module_map_id AS VARCHAR) FROM ca
      UNION ALL SELECT 'module', CAST(module_id AS VARCHAR) FROM va
      UNION ALL SELECT 'module kind', 'en_us|' || module_type_id || '|1|0|' || placement_type || '|' || channel FROM sl
      UNION ALL SELECT 'segment', '1|0|' || segment_type_id FROM sl
      UNION ALL SELECT 'segment', '1|0|' || campaign_segment_type_id FROM ca)
    SELECT relation, key, 'duplicate' AS violation, count(*) AS n FROM defs WHERE u GROUP BY relation, key HAVING count(*) > 1
    UNION ALL
    SELECT relation, key, 'missing', count(*) FROM refs r WHERE NOT EXISTS (SELECT 1 FROM defs d WHERE d.relation = r.relation AND d.key = r.key) GROUP BY relation, key""",
)
_STRICT = build_ctes(strict=True)
_COMPAT = build_ctes(seeds_per_campaign=False)
ORACLE["slot_choice_strict"] = compose(["rendered"], "SELECT * EXCLUDE (OmniExtension, OmniExtNewFormat) FROM rendered", _STRICT)
ORACLE["demoted_modules_strict"] = compose(
    ["rc"], f"SELECT {', '.join(KEYS)}, slot_position, module_id, eff AS effective_priority, att_option FROM rc", _STRICT
)
ORACLE["output_contract_compat"] = compose(["final"], "SELECT * FROM final", _COMPAT)
