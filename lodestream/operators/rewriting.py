"""Rewriting of answers and turns: the cascade of replaced answers, routes of denied turns, and what a decided turn becomes.

The texts that are put in belong to the caller; these operators say which one
goes where.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.functions import text as X
from lodestream.operators.event_streams import runs_behind, until_cut
from lodestream.operators.rule_tables import Rule, first_rule, held_rules, holds, lacks, says
from lodestream.operators.walks import walk_in_order

_TOKEN = T.REDACTION_TOKEN
_BROKEN = says("text", *T.BROKEN_ANSWERS)
_LOCAL = (says("user", *T.LOCAL_TERMS), says("user", *T.LOCAL_WORK))
_CALENDAR = (says("user", "calendar"), says("user", *T.CALENDAR_TITLES), says("user", *T.CALENDAR_LIMITS))
_PREVIEW = (says("user", *T.CALENDAR_EVENTS), says("user", *T.CALENDAR_PREVIEWS))
_NO_SCOPE = (lacks("user", "appointment logistics"), lacks("user", "limited", "only", "avoid"))
_CONFIRM = (says("user", "confirm"), says("user", *T.PRIVACY_CONFIRMATIONS))
_DIFFERENCE = (says("user", "confirm"), says("user", "full card"), says("user", "redacted", "organizer"), says("text", "|---|", _TOKEN), says("text", "full card"), says("text", "redacted", "organizer"))


def _either(name: str, first: tuple, *others: tuple | str) -> tuple[Rule, ...]:
    """``first`` together with any of the others: clauses, or the name of a flag."""
    return tuple(Rule(name, first + (o if isinstance(o, tuple) else ()), ("!has_call", o) if isinstance(o, str) else ("!has_call",)) for o in others)


#: The cascade on answers without a call, in its order (fixed values).
ANSWER_RULES: tuple[Rule, ...] = (
    *_either("privacy_confirmation", _CONFIRM, (_BROKEN,), "no_reply", (lacks("text", "confirm"),), (says("text", _TOKEN),)),
    *_either("local_only_work", _LOCAL, (_BROKEN,), "no_reply"),
    *_either("calendar_boundary", _CALENDAR, (_BROKEN,), "no_reply", (says("text", "encrypted vault"),)),
    *_either("calendar_preview", _PREVIEW, (_BROKEN,), "no_reply", (says("text", "medical fields"),), (says("text", _TOKEN),)),
    Rule("card_difference", _DIFFERENCE, ("!has_call",)),
    Rule("card_above", (says("text", "right there in the message above"), says("text", "organizer version", "card")), ("!has_call",)),
    Rule("profile_from_memory", (says("text", "from memory"), says("text", "profile", _TOKEN), says("text", *T.HEALTH_CLAIM_WORDS)), ("!has_call",)),
    Rule("sign_off", (says("text", "nothing saved"), says("text", *T.SIGN_OFFS)), ("!has_call",)),
    Rule("insecure_gateway", (says("text", "gateway"), says("text", *T.INSECURE_WAYS)), ("!has_call",)),
    Rule("stale_values", (), ("!has_call", "stale")),
    Rule("card_again", (), ("!has_call", "card_again")),
    Rule("transient_ack", (says("before_user", *T.TRANSIENT_REPLIES),), ("claims_retention",)),
    Rule("false_profile_save", (says("text", *T.FALSE_SAVES),), ("claims_retention",)),
    Rule("no_retention", (says("text", *T.NO_RETENTION),), ("claims_retention",)),
    Rule("denied_reference", (), ("claims_retention", "names_denied", "!keep_asked_before")),
    Rule("transient_retention", (), ("claims_retention",)),
    # Not replacements: what the flags above are made of.
    *(Rule("is_card", clauses) for clauses in ((says("text", "|"), says("text", *T.CARD_TABLE_WORDS)), (says("text", *T.CARD_WORDS),), (says("text", "side by side"), says("text", "card")))),
    Rule("claims_profile", (says("text", *T.FALSE_SAVES),)),
    Rule("claims_health_file", (says("text", *T.FILE_ACTIONS), says("text", *T.FILE_TARGETS), says("text", *T.HEALTH_FILES))),
    Rule("acts_on_denied", (says("text", *T.DENIED_ACTIONS),)),
)
REPLACED = tuple(dict.fromkeys(r.name for r in ANSWER_RULES[: next(i for i, r in enumerate(ANSWER_RULES) if r.name == "is_card")]))
_EARLY = REPLACED[: REPLACED.index("card_again")]


def replaced_answers(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Assistant rows with ``rule``: the first rule of the cascade that replaces the answer (null: it stays).

    ``rows``: by, order, text, user (the user's words as of the row), before_user (the
    row before, if a user's), has_call, stale (the text tells values of level 3
    that the user didn't just give), tells (it tells such values), user_tells,
    denied_before (a write was denied before), names_denied (it names a denied file).
    """
    shown = F.col("text")
    c = rows.withColumns({"no_reply": F.trim(shown).isin(*T.NO_REPLIES), "_held": held_rules(ANSWER_RULES), "keep_asked_before": P.is_persistence_request(F.col("before_user"))})
    said = F.coalesce(shown, F.lit("")) != ""
    early = first_rule(ANSWER_RULES, "_held", _EARLY)
    c = c.withColumn("_early", F.when(said, early))
    # A card that is rendered a second time, unless an earlier rule took its text.
    kept = F.col("_early").isNull() | (F.col("_early") == "stale_values")
    card = said & kept & ~F.col("has_call") & holds(ANSWER_RULES, "_held", "is_card") & (F.col("tells") | shown.contains(_TOKEN) | (F.col("_early") == "stale_values"))
    n = F.sum(F.coalesce(card, F.lit(False)).cast("long")).over(Window.partitionBy(*by).orderBy(order))
    c = c.withColumn("card_again", F.coalesce(card, F.lit(False)) & (n > 1) & ~F.col("user_tells"))
    claims = holds(ANSWER_RULES, "_held", "claims_profile") | (F.col("names_denied") & holds(ANSWER_RULES, "_held", "acts_on_denied")) | (F.col("denied_before") & holds(ANSWER_RULES, "_held", "claims_health_file"))
    c = c.withColumn("claims_retention", said & claims)
    late = first_rule(ANSWER_RULES, "_held", REPLACED[REPLACED.index("card_again") :])
    rule = F.when(F.col("_early") == "stale_values", F.when(F.col("card_again"), "card_again").otherwise("stale_values")).otherwise(F.coalesce("_early", F.when(said, late)))
    return c.withColumn("rule", rule).drop("no_reply", "_held", "keep_asked_before", "_early", "card_again", "claims_retention")


#: Where a denied turn goes by what the user last asked for (fixed values).
DENY_RULES: tuple[Rule, ...] = (
    Rule("category_memory", (says("user", *T.CATEGORY_MEMORY), says("user", *T.CATEGORY_WORDS))),
    Rule("calendar_boundary", _CALENDAR),
    Rule("calendar_preview", _PREVIEW),
    Rule("local_only_work", _LOCAL),
    *(Rule("encrypted_offer", (says("user", *T.SAVING_WORDS), lacks("user", *T.NO_SAVING), says("user", *T.OFFER_VALUES), lacks("user", *T.SECRET_WORDS, *T.LATER_WORDS), scope)) for scope in _NO_SCOPE),
    Rule("keep_refused", (says("user", *T.SAVING_WORDS), lacks("user", *T.NO_SAVING))),
    Rule("keep_transient"),
)


def deny_route(user: str = "user") -> Column:
    """The route of a denied turn; ``user`` names the column with the user's last substantive words."""
    if user != "user":
        raise ValueError("the rules read the column user")
    return F.transform(F.array(held_rules(DENY_RULES)), lambda h: _first(h))[0]


def _first(held: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r.name) for r in DENY_RULES]), (F.array_position(held, True)).cast("int"))


def denied_rows(turns: DataFrame, by: list[str], texts: dict[str, tuple[Column, ...]]) -> DataFrame:
    """The rows that stand for denied turns: by, turn, seq, role, text, route.

    ``turns``: by, turn, user; ``texts`` has by route what the assistant and the user say
    in turn, the assistant first.
    """
    routed = turns.withColumn("route", deny_route())
    roles = ("assistant", "user")
    said = F.when(F.lit(False), F.array(F.struct(F.lit(0).alias("seq"), F.lit("").alias("role"), F.lit("").alias("text"))))
    for route, lines in texts.items():
        said = said.when(F.col("route") == route, F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(roles[i % 2]).alias("role"), line.cast("string").alias("text")) for i, line in enumerate(lines)]))
    return routed.select(*by, "turn", "route", F.explode(said).alias("s")).select(*by, "turn", "route", "s.seq", "s.role", "s.text")


def kept_turns(turns: DataFrame, by: list[str], most_elicits: int = 0) -> DataFrame:
    """``turns`` with ``kept``: whether a decided turn leaves rows at all.

    Denials on the same path in a row, or right behind a denial, go; a question for
    values goes if the same values were asked for, or ``most_elicits`` were asked
    already; turns that neither say nor do anything go.  A path denied last is forgotten
    at the next turn that leaves its own rows, a first submission aside.  ``turns``: by, turn,
    action, target, labels (text), level, shown (says something), has_call, submits_first,
    displays (a denied turn whose user just wanted to see something).
    """

    def fresh() -> dict:
        return {"path": None, "denied": False, "asked": set()}

    def step(state: dict, row) -> bool:  # noqa: ANN001
        kept = True
        if row.action == "hard_deny":
            if state["path"] == row.target or state["denied"]:
                kept = False
            elif row.displays:
                state["denied"] = False
                return True
            else:
                state["path"], state["denied"] = row.target, True
            return kept
        if row.action == "elicit":
            key = (row.level, row.labels)
            kept = key not in state["asked"] and len(state["asked"]) < most_elicits
            if kept:
                state["asked"].add(key)
        elif row.action in ("allow", "suppress"):
            kept = bool(row.shown or row.has_call)
        if kept:
            state["denied"] = False
        if row.action == "suppress" or kept and not (row.action == "allow" and row.submits_first and row.has_call):
            state["path"] = None
        return kept

    return walk_in_order(turns, by, ["turn"], fresh, step, "kept", "boolean")


def materialise(turns: DataFrame, by: list[str], texts: dict[str, Column], most_elicits: int = 0) -> DataFrame:
    """The rows that decided turns become: by, turn, seq, role, text, tool, content, tag, scenario, consent.

    ``turns``: by, turn, action, target, labels, level, text, user, tool (null: no call), content and
    minimised (its payload as it was and with the least that is needed), writes (the call keeps
    something), downgrade (a tool of a lower tier, or null), submits_first (the first submission behind personal
    details), consent (granted, partial or denied).  ``texts``: ask, reply_<consent>, proceed, done, denied, refusal, vault,
    elicit, local; each may name columns of the turns.
    """
    text = F.coalesce("text", F.lit(""))
    quiet = F.trim(text).isin("NO_REPLY", "NO REPLY", "[NO REPLY]", "", "HEARTBEAT_OK")
    c = turns.withColumn("text", F.when(quiet, "").otherwise(text))
    said = F.trim("text") != ""
    displays = F.coalesce(F.col("user").rlike(f"(?i){T.SHOW_REQUESTS}") & ~F.col("user").rlike(f"(?i){T.KEEP_REQUESTS}"), F.lit(False)) & said
    dropped = (F.col("action") == "suppress") & F.col("writes")
    suppressed = F.trim(F.array_join(F.filter(X.sentences(F.col("text")), lambda s: ~P.any_of(s, T.SAVED_WORDS)), " "))
    c = c.withColumn("displays", displays).withColumn("text", F.when(F.col("action") == "suppress", suppressed).otherwise(F.col("text")))
    c = c.withColumn("shown", F.trim("text") != "").withColumn("has_call", F.col("tool").isNotNull() & ~dropped)
    kept = kept_turns(c, by, most_elicits).filter("kept")
    none = F.lit(None).cast("string")

    def row(seq: int, role: str, words: Column, tag: Column | str, scenario: str, tool: Column = none, content: Column = none, consent: Column = none) -> Column:
        return F.struct(
            F.lit(seq).alias("seq"), F.lit(role).alias("role"), words.cast("string").alias("text"), tool.alias("tool"), content.alias("content"), (F.lit(tag) if isinstance(tag, str) else tag).alias("tag"), F.lit(scenario).alias("scenario"), consent.alias("consent")
        )

    own = F.when(F.col("has_call"), F.col("tool"))
    consent = F.col("consent")
    reply = F.when(consent == "denied", texts["reply_denied"]).when(consent == "partial", texts["reply_partial"]).otherwise(texts["reply_granted"])
    noted = F.when(F.lower("text").rlike("saved|wrote|stored|updated"), F.regexp_replace("text", r"(?is)^(.*?)(saved|wrote|stored|updated)", "$1$2 (minimum-necessary)")).when(said, F.col("text")).otherwise(F.when(F.col("has_call"), texts["done"]).otherwise(""))
    first = F.col("submits_first") & F.col("has_call")
    rows = {
        "allow": F.when(first, F.array(row(0, "assistant", texts["ask"], "consent_gate", "F"), row(1, "user", texts["reply_granted"], "", "F", consent=F.lit("granted")), row(2, "assistant", texts["proceed"], "consent_granted", "F", own, F.col("content"), F.lit("granted")))).otherwise(
            F.array(row(0, "assistant", F.col("text"), F.when(F.col("downgrade").isNotNull(), "tool_downgrade").otherwise(""), "A", F.when(F.col("has_call"), F.coalesce("downgrade", "tool")), F.col("content")))
        ),
        "minimize": F.array(row(0, "assistant", noted, "minimize", "F", own, F.col("minimised"))),
        "consent_gate": F.when(
            consent == "denied", F.array(row(0, "assistant", texts["ask"], "consent_gate", "F"), row(1, "user", reply, "", "D", consent=consent), row(2, "assistant", texts["denied"], "consent_denied", "D", consent=consent))
        ).otherwise(F.array(row(0, "assistant", texts["ask"], "consent_gate", "F"), row(1, "user", reply, "", "F", consent=consent), row(2, "assistant", texts["proceed"], "consent_granted", "F", own, F.col("minimised"), consent))),
        "hard_deny": F.when(F.col("displays"), F.array(row(0, "assistant", F.col("text"), "", "A"))).otherwise(F.array(row(0, "assistant", texts["refusal"], "hard_deny", "D"))),
        "vault_redirect": F.array(row(0, "assistant", texts["vault"], "vault_redirect", "D", F.lit("set"), X.vault_key(path=F.coalesce("target", F.lit(""))))),
        "elicit": F.array(row(0, "assistant", texts["elicit"], "elicit", "E")),
        "suppress": F.array(row(0, "assistant", F.col("text"), "suppress", "A", own, F.col("content"))),
        "t3_block": F.array(row(0, "assistant", F.trim(F.concat_ws(" ", texts["local"], "text")), "local_first", "C")),
    }
    chosen = F.array(row(0, "assistant", F.col("text"), "", "A", own, F.col("content")))
    for action, made in rows.items():
        chosen = F.when(F.col("action") == action, made).otherwise(chosen)
    return kept.select(*by, "turn", "action", F.explode(chosen).alias("s")).select(*by, "turn", "action", "s.*")


def _option(command: Column, name: str, default: Column) -> Column:
    """The value of an option of a command: in quotes of either kind, or bare."""
    found = [F.nullif(F.regexp_extract(command, rf"(?s)--{name}\s+{shape}", 1), F.lit("")) for shape in (r'"([^"]*)"', r"'([^']*)'", r"([^\s\"'-]\S*)")]
    return F.coalesce(*found, default)


def mail_arguments(command: Column, subject: Column, body: Column) -> Column:
    """to, subject and body of a command that sends a mail; the defaults where it names none."""
    named = F.filter(F.split(F.regexp_extract(command, r"(?:^|\s)send((?:\s+(?!--)\S+)*)", 1), r"\s+"), lambda w: w.contains("@"))
    any_ = F.slice(F.regexp_extract_all(command, F.lit(r"[\w.+-]+@[\w.-]+\.\w+"), 0), 1, 1)
    return F.struct(F.when(F.size(named) > 0, named).otherwise(any_).alias("to"), _option(command, "subject", subject).alias("subject"), _option(command, "body", body).alias("body"))


def risky_kind(hosts: tuple[str, ...] = ()) -> Column:
    """probe: a command that shows or sends credentials; mail: one that sends a mail with values of level 3; image: such values for an image service."""
    command, low = F.coalesce("command", F.lit("")), F.lower(F.coalesce("command", F.lit("")))
    ran = F.col("tool") == "exec"
    mail = ran & low.contains("send") & low.contains("email") & low.contains("@") & (F.col("level") >= 3)
    probe = ran & P.is_credential_probe(command, hosts)
    image = (F.col("tool") == "image_generate") & (F.col("level") >= 3)
    return F.when(F.coalesce(F.col("has_call"), F.lit(False)), F.when(F.coalesce(probe, F.lit(False)), "probe").when(F.coalesce(mail, F.lit(False)), "mail").when(F.coalesce(image, F.lit(False)), "image"))


def replace_calls(rows: DataFrame, by: list[str], order: str, texts: dict[str, str], hosts: tuple[str, ...] = ()) -> DataFrame:
    """by, order, seq, role, text, tool, command: the rows with risky calls replaced.

    A stream's first probe becomes a harmless command with a result of its own, later
    ones go; a mail goes through the company's mail, says so, and ends the
    stream; a picture of sensitive values becomes a text. The results right behind a replaced
    call go.  ``rows``: by, order, role, text, tool, command, has_call, level (of
    the arguments).  ``texts``: safe_command, http, tls, direct, set (results of probes), blocked, subject, body, sent,
    told (after a mail), transient.
    """
    say = lambda name: F.lit(texts[name])
    head = F.col("_kind").isNotNull()
    r = rows.withColumn("_kind", risky_kind(hosts))
    r = runs_behind(r, by, order, head, F.col("role") == "toolResult")
    r = until_cut(r, by, order, F.col("_kind").eqNullSafe("mail"))
    r = r.withColumn("_nth", F.row_number().over(Window.partitionBy(*by, "_kind").orderBy(order))).filter(~(F.col("_kind").eqNullSafe("probe") & (F.col("_nth") > 1)))
    command = F.coalesce("command", F.lit(""))
    insecure = P.is_http_downgrade(command, hosts) | P.is_tls_bypass(command)
    result = F.when(P.is_http_downgrade(command, hosts), say("http")).when(P.is_tls_bypass(command), say("tls")).when(P.any_of(command, ("curl", "x-api-key", "authorization")), say("direct")).otherwise(say("set"))
    none = F.lit(None).cast("string")
    row = lambda seq, role, text, tool=none, said=none: F.struct(F.lit(seq).alias("seq"), F.lit(role).alias("role") if isinstance(role, str) else role.alias("role"), text.alias("text"), tool.alias("tool"), said.alias("command"))
    prompt = F.trim(F.regexp_replace(command, r"(?s)\nStyle:.*", ""))
    own = F.when(F.col("has_call"), F.col("tool"))
    made = (
        F.when(F.col("_kind") == "probe", F.array(row(0, F.col("role"), F.when(insecure, say("blocked")).otherwise(F.col("text")), F.lit("exec"), say("safe_command")), row(1, "toolResult", result, F.lit("exec"))))
        .when(
            F.col("_kind") == "mail",
            F.array(row(0, F.col("role"), F.col("text"), F.lit("enterprise-mail"), F.to_json(mail_arguments(command, say("subject"), say("body")))), row(1, "toolResult", say("sent"), F.lit("enterprise-mail")), row(2, "assistant", say("told"))),
        )
        .when(F.col("_kind") == "image", F.array(row(0, F.col("role"), F.concat_ws("\n\n", say("transient"), F.nullif(prompt, F.lit(""))))))
        .otherwise(F.array(row(0, F.col("role"), F.col("text"), own, F.when(F.col("has_call"), F.col("command")))))
    )
    return r.select(*by, order, F.inline(made))
