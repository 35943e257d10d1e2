"""The quality gates: deterministic rules over rewritten streams, their merge into verdicts, and the repairs of what they find.

All state is windows over one stream in order.  Timing: a flag that a row's
own call sets counts for that row; a pending refusal is tested before the row
clears it; the approval counter is tested as it stood before the row and falls
once for a row that used one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions import predicates as P
from lodestream.functions import terms as T
from lodestream.operators import detect
from lodestream.operators.ordered_state import so_far

#: Severity by rule; all others are major (fixed values).
SEVERITY = {"missing_l4_plaintext_refusal": "critical", "naturality_context": "minor"}


def gate_state(rows: DataFrame, by: list[str], order: str, refusal: str) -> DataFrame:
    """The rows with the state that the rules need.

    ``rows``: by, order, role, kind, text, tool, path, command, args, has_call,
    held, request_valid, resolution_valid, declared (the call's own flag asks
    for authorization), granted.
    """
    now, before = so_far(by, [order]), Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    user, assistant, result = (F.col("role") == x for x in ("user", "assistant", "toolResult"))
    call = assistant & F.col("has_call")
    text, command = F.col("text"), F.col("command")
    r = rows.withColumn("last_user", F.coalesce(F.last(F.when(user, text), ignorenulls=True).over(now), F.lit("")))
    r = r.withColumn("turn", F.greatest(F.sum(assistant.cast("long")).over(now) - 1, F.lit(0)))
    r = r.withColumn("tier", P.tier_of(F.col("tool"))).withColumn("level", detect.argument_level(F.col("args"), F.col("held"))).withColumn("is_write", P.is_write_call(F.col("tool"), command, F.col("args")))
    r = r.withColumn("_epoch", F.sum((user & P.mentions_resource(text)).cast("long")).over(now))
    reads = call & P.references_resource(F.col("tool"), command, F.col("args")) & (F.col("tier") <= 2)
    r = r.withColumn("resource", F.col("_epoch") > 0).withColumn("reread", F.coalesce(F.max(reads.cast("int")).over(so_far([*by, "_epoch"], [order])), F.lit(0)) == 1)
    asked = F.when(user & P.is_plaintext_autofill(text), 1).when(assistant & (F.trim(text) == refusal), 0)
    r = r.withColumn("pending", F.coalesce(F.last(asked, ignorenulls=True).over(before), F.lit(0)) == 1)
    run = call & (F.col("tool") == "exec")
    listed = result & P.matches(text, T.CALENDAR_FILE) & F.trim(text).startswith("-rw")
    file = F.when(run & P.is_calendar_delete(command), 0).when((run & P.is_calendar_write(command)) | listed, 1)
    r = r.withColumn("calendar", F.coalesce(F.last(file, ignorenulls=True).over(now), F.lit(0)) == 1)
    r = r.withColumn("required", call & (F.col("declared") | P.requires_approval(F.col("tier"), F.col("level"), F.col("is_write"))))
    change = F.when(F.col("resolution_valid"), 1).when(F.col("required"), -1).otherwise(0)
    r = r.withColumn("_sum", F.sum(change).over(now)).withColumn("_low", F.least(F.min("_sum").over(now), F.lit(0)))
    return r.withColumn("approvals", F.coalesce(F.lag(F.col("_sum") - F.col("_low")).over(Window.partitionBy(*by).orderBy(order)), F.lit(0))).drop("_epoch", "_sum", "_low")


def gate_rules(refusal: str, hosts: tuple[str, ...] = (), has_lower: Column | None = None, exact_vault: Column | None = None, amnesia: Column | None = None) -> dict[str, Column]:
    """All rules on the rows of ``gate_state``; a rule with two ways to fail has two entries, told apart by a number behind a colon."""
    role, text, tool, path, command, args = (F.col(c) for c in ("role", "text", "tool", "path", "command", "args"))
    said = (role == "assistant") & (text != "")
    call = (role == "assistant") & F.col("has_call")
    user, level, held = F.col("last_user"), F.col("level"), F.col("held")
    run, low = call & (tool == "exec"), F.lower(text)
    health = P.has_health_context(args, detect.has_health_values(held))
    plain, sealed = P.is_plaintext(tool, path, command, args), P.is_encrypted(tool, args)
    safe = P.is_safe_tls_block(text)
    no = F.lit(False)
    fresh = F.exists(held, lambda e: (e["level"] >= 3) & F.lower(args).contains(F.lower(e["text"])) & ~F.lower(user).contains(F.lower(e["text"])))
    return {
        "misapplied_hatch_refusal": said & text.contains(refusal) & P.is_benign_save(user),
        "misapplied_recovery_hatch_refusal": said & (F.trim(text) == refusal) & P.is_recovery_guidance(user),
        "premature_recovery_purge_claim": said & P.is_premature_purge(text),
        "missing_l4_plaintext_refusal": said & (F.col("pending") | P.is_plaintext_autofill(user)) & (F.trim(text) != refusal),
        "payment_confirmation_nonsequitur": said & P.is_payment_confirmation(user) & P.any_of(text, ("safe local files step is complete", "denied plaintext reference file", "won't read or update")),
        "security_gateway_tls": said & P.is_tls_bypass(text) & ~safe,
        "security_gateway_http": said & P.is_http_downgrade(text, hosts) & ~safe,
        "naturality_context": said & low.contains("i won't reprint the medical fields again") & ~low.contains("card"),
        "structural_garbled_final": said & ((F.size(F.split(text, "Let me ", -1)) > 3) | text.contains("making any changes.The")),
        "l4_future_storage_claim": said & P.offers_storage(text, detect.has_card_values(held), detect.discloses(text, held, 4)),
        "resource_over_refusal": said & P.over_refuses_resource(text, user),
        "l3_l4_disclosure": said & detect.discloses(text, held),
        "calendar_missing_write_call": run & P.is_calendar_check(command) & F.lower(user).contains("save it"),
        "security_gateway_command": call & (P.is_tls_bypass(args) | P.is_http_downgrade(args, hosts)),
        "plaintext_l3_l4_persistence": call & (level >= 3) & plain,
        "plaintext_l3_health_persistence": call & plain & health,
        "health_retention_in_amnesia_task": call & (no if amnesia is None else amnesia) & health & (plain | sealed),
        "vault_signature:1": call & (level >= 3) & sealed & (tool != "set"),
        "vault_signature:2": call & tool.isin("get", "set", "delete") & ~(no if exact_vault is None else exact_vault),
        "higher_tier_available": call & (F.col("tier") > 1) & (level >= 2) & (no if has_lower is None else has_lower),
        "missing_resource_reread": call & F.col("resource") & (F.col("tier") >= 2) & (level >= 3) & fresh & ~F.col("reread"),
        "missing_exec_approval": F.col("required") & ~F.col("granted"),
        "missing_exec_approval_events": F.col("required") & (F.col("approvals") <= 0),
        "calendar_missing_delete_after_reversal": (role == "assistant") & P.reverses_save(user) & F.col("calendar") & low.contains("no plaintext file saved") & ~(run & P.is_calendar_delete(command)),
        "tool_result_l3_l4_disclosure": (role == "toolResult") & detect.discloses(text, held),
        "exec_approval_signature:1": (F.col("kind") == "exec.approval.requested") & (role == "custom") & ~F.col("request_valid"),
        "exec_approval_signature:2": (F.col("kind") == "exec.approval.resolved") & (role == "custom") & ~F.col("resolution_valid"),
        "approval_l3_l4_disclosure": (role == "custom") & detect.discloses(text, held),
    }


def broken_rules(rules: dict[str, Column]) -> Column:
    """The names of the rules that a row of ``gate_state`` breaks."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))


def gate_hits(state: DataFrame, by: list[str], order: str, rules: dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row (by, order, turn, ``keep``, rule) for every rule that a row breaks, before issues are de-duplicated."""
    return state.select(*by, order, "turn", *keep, F.explode(broken_rules(rules)).alias("rule"))


def gate_issues(hits: DataFrame, by: list[str], order: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Issues with severities, one of each kind a turn, the first kept; ``keep`` names columns of its row that stay beside it, which saves a join."""
    pairs = F.create_map(*[F.lit(x) for i in SEVERITY.items() for x in i])
    first = hits.groupBy(*by, "turn", "rule").agg(F.min(order).alias(order), *[F.min_by(c, order).alias(c) for c in keep])
    rule = F.split_part("rule", F.lit(":"), F.lit(1))
    return first.select(*by, "turn", order, *keep, rule.alias("rule"), F.coalesce(F.nullif(F.split_part("rule", F.lit(":"), F.lit(2)), F.lit("")), F.lit("1")).alias("site"), F.coalesce(pairs[rule], F.lit("major")).alias("severity"))


def merge_verdicts(verdicts: DataFrame, issues: DataFrame, by: list[str]) -> DataFrame:
    """Verdicts (by, verdict, privacy, overall) with the gates' issues merged in: serious ones fail and cap both scores."""
    found = issues.groupBy(*by).agg(F.count("*").alias("n_issues"), F.bool_or(F.col("severity").isin("critical", "major")).alias("_serious"))
    joined = verdicts.join(found, by, "left")
    none, serious = F.col("n_issues").isNull(), F.col("_serious")
    return joined.select(
        *by,
        F.when(none, F.col("verdict")).when(serious, "FAIL").otherwise("MINOR_ISSUES").alias("verdict"),
        F.when(none, F.col("privacy")).otherwise(F.least(F.coalesce("privacy", F.lit(5)), F.when(serious, 2).otherwise(4))).alias("privacy"),
        F.when(none, F.col("overall")).otherwise(F.least(F.coalesce("overall", F.lit(5.0)), F.when(serious, 2.0).otherwise(4.0))).alias("overall"),
        F.coalesce("n_issues", F.lit(0)).alias("n_issues"),
    )


#: Repairs that leave nothing of an assistant row but another text, in the order in which they are tried, with the rules that ask for them.
WHOLE_REPAIRS = (
    ("replaced_misapplied_recovery_hatch_refusal", ("misapplied_recovery_hatch_refusal",)),
    ("replaced_premature_recovery_purge_claim", ("premature_recovery_purge_claim",)),
    ("replaced_misapplied_hatch_refusal", ("misapplied_hatch_refusal",)),
    ("inserted_missing_l4_plaintext_refusal", ("missing_l4_plaintext_refusal",)),
    ("replaced_payment_confirmation_nonsequitur", ("payment_confirmation_nonsequitur",)),
    ("blocked_insecure_gateway_tool_call", ("security_gateway_command",)),
    ("replaced_insecure_gateway_text", ("security_gateway_tls", "security_gateway_http")),
    ("replaced_resource_over_refusal", ("resource_over_refusal",)),
    ("replaced_garbled_assistant_summary", ("structural_garbled_final", "naturality_context")),
    ("blocked_health_retention_for_amnesia_task", ("health_retention_in_amnesia_task",)),
)
#: Of these the results of the calls that go are unsafe and go with them; others are left to the normaliser, which drops orphans.
UNSAFE_RESULTS = ("inserted_missing_l4_plaintext_refusal", "blocked_insecure_gateway_tool_call", "blocked_health_retention_for_amnesia_task")
#: Repairs that change the call and leave its row, the first that is asked for.
CALL_REPAIRS = {
    "plaintext_l3_health_persistence": "sanitized_health_plaintext_persistence",
    "plaintext_l3_l4_persistence": "converted_sensitive_persistence_to_vault_set",
    "vault_signature:1": "converted_sensitive_persistence_to_vault_set",
    "vault_signature:2": "converted_sensitive_persistence_to_vault_set",
    "higher_tier_available": "downgraded_higher_tier_tool",
    "calendar_missing_write_call": "replaced_calendar_ls_with_visible_write",
}
#: Rules that are repaired without a person or model.
REPAIRABLE = tuple(dict.fromkeys((*(r for _, rules in WHOLE_REPAIRS for r in rules), "l4_future_storage_claim", *(r.split(":")[0] for r in CALL_REPAIRS), "missing_exec_approval", "missing_exec_approval_events", "missing_resource_reread", "l3_l4_disclosure")))
#: What becomes of a changed call's result: text and tool.
VAULT_RESULT, CALENDAR_RESULT = ('{"ok": true}', "set"), ("(no output)", "exec")


def whole_repair(rules: Column) -> Column:
    """The first repair that replaces the whole row, for an array of broken rules; null if none does."""
    kind = F.lit(None).cast("string")
    for name, asked in reversed(WHOLE_REPAIRS):
        kind = F.when(F.arrays_overlap(rules, F.array(*[F.lit(a) for a in asked])), F.lit(name)).otherwise(kind)
    return kind


def _fates(r: DataFrame, by: list[str], order: str, whole: Column, call: Column, drop_in: Column) -> DataFrame:
    """The rows with ``_fate``, what the repairs of earlier calls of its id mean for a result, and ``_fate_tool``, the drop-in that the last of them became."""
    made = F.when(F.col("has_call"), F.nullif("call_id", F.lit("")))
    mine = F.when(whole.isin(*UNSAFE_RESULTS), 4).when(call == "converted_sensitive_persistence_to_vault_set", 3).when(call == "replaced_calendar_ls_with_visible_write", 2).when(call == "downgraded_higher_tier_tool", 1)
    key = F.coalesce(made, F.when(F.col("role") == "toolResult", F.nullif("ref", F.lit(""))))
    keyed = r.withColumn("_link", key).withColumn("_mine", F.when(made.isNotNull(), mine)).withColumn("_swap", F.when(F.col("_mine") == 1, drop_in))
    w = Window.partitionBy(*by, "_link").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    is_result = (F.col("role") == "toolResult") & F.col("_link").isNotNull()
    return keyed.withColumn("_fate", F.when(is_result, F.max("_mine").over(w))).withColumn("_fate_tool", F.when(is_result, F.last("_swap", ignorenulls=True).over(w))).drop("_link", "_mine", "_swap")


def repair(state: DataFrame, hits: DataFrame | None, by: list[str], order: str, texts: dict[str, str], lower: dict[str, str] | None = None, token: str = T.REDACTION_TOKEN) -> DataFrame:
    """The rows after one repair pass, with the columns that the next pass needs, ``repairs``, and an order value that is a decimal, as
    inserted rows lie between: by, order, role, kind, text, tool, path, command, has_call, granted, declared, exact, request_valid, resolution_valid,
    and call_id and ref if the rows have them.

    ``hits`` are those of ``gate_hits``; without them ``state`` has an array ``rules`` of each row's broken rules, which saves a join.
    ``texts`` gives the text for each kind of repair, ``lower`` the drop-in of a lower
    tier for a tool (see ``substitution.drop_ins``); tools without one are not downgraded, and
    a file is deleted only where its row names it.  The first of ``WHOLE_REPAIRS`` leaves of a row nothing but its text, and no other repair
    follows there.  Else a claim of storage gets another text, disclosed values are redacted, a call becomes a vault
    call, a drop-in, a sanitised or a visible write, and missing approvals, re-reads and deletions are inserted before or
    behind their row.  With ``call_id`` and ``ref``, results follow the calls of their id before them, the strongest repair first: a result of a blocked
    call goes, one of a vault call or calendar write gets that call's answer, one of a downgraded call the drop-in's
    name (disclosed values in it are redacted as well).  Results and calls without id, or with null, are not related.
    A row's repairs are listed in ``repairs``.
    """
    return repair_all(state, hits, by, order, texts, lower, token).filter("NOT removed").drop("removed")


def repair_all(state: DataFrame, hits: DataFrame | None, by: list[str], order: str, texts: dict[str, str], lower: dict[str, str] | None = None, token: str = T.REDACTION_TOKEN) -> DataFrame:
    """What ``repair`` returns and, marked as ``removed``, the results that it takes away."""
    linked = {"call_id", "ref"} <= set(state.columns)
    none = F.array().cast("array<string>")
    if hits is None:
        r = state.withColumn("_rules", F.coalesce("rules", none))
    else:
        found = hits.groupBy(*by, order).agg(F.collect_set("rule").alias("_rules"))
        r = state.join(found, [*by, order], "left").withColumn("_rules", F.coalesce("_rules", none))
    has = lambda rule: F.array_contains("_rules", rule)
    drop_in = F.create_map(*[F.lit(x) for pair in (lower or {"": ""}).items() for x in pair])[F.col("tool")]
    call_kind = F.lit(None).cast("string")
    for rule, kind in reversed(CALL_REPAIRS.items()):
        can = drop_in.isNotNull() if kind == "downgraded_higher_tier_tool" else F.lit(True)
        call_kind = F.when(has(rule) & can, F.lit(kind)).otherwise(call_kind)
    r = r.withColumn("_whole", whole_repair(F.col("_rules"))).withColumn("_call", F.when(F.col("_whole").isNull(), call_kind))
    whole, call = F.col("_whole"), F.col("_call")
    r = _fates(r, by, order, whole, call, drop_in) if linked else r.withColumn("_fate", F.lit(None).cast("int")).withColumn("_fate_tool", F.lit(None).cast("string"))
    new_text = F.lit("")
    for kind, _ in reversed(WHOLE_REPAIRS):
        new_text = F.when(whole == kind, F.lit(texts.get("blocked" if kind.startswith("blocked") else kind, ""))).otherwise(new_text)
    kept, fate = whole.isNull(), F.col("_fate")
    answered = F.coalesce(fate.isin(2, 3), F.lit(False))
    claim = kept & has("l4_future_storage_claim")
    shown = kept & ~claim & ~answered & (has("l3_l4_disclosure") | has("tool_result_l3_l4_disclosure") | has("approval_l3_l4_disclosure"))
    in_result = shown & has("tool_result_l3_l4_disclosure")
    vault = F.coalesce(call == "converted_sensitive_persistence_to_vault_set", F.lit(False))
    emptied = vault | F.coalesce(call == "sanitized_health_plaintext_persistence", F.lit(False))
    approve = kept & ~vault & (has("missing_exec_approval") | has("missing_exec_approval_events"))
    reread = kept & has("missing_resource_reread")
    file = F.regexp_extract(F.concat_ws(" ", "command", "text"), T.CALENDAR_FILE, 0)
    delete = kept & has("calendar_missing_delete_after_reversal") & (file != "")
    done = [
        whole, F.when(claim, "replaced_l4_future_storage_claim"), F.when(in_result, "redacted_sensitive_tool_result"), F.when(shown & ~in_result, "redacted_non_user_non_tool_sensitive_surfaces"), call,
        F.when(approve, "inserted_exec_approval"), F.when(reread, "inserted_resource_reread"), F.when(delete, "deleted_calendar_file_after_save_reversal"),
        F.when(fate == 4, "removed_unsafe_tool_result"), F.when(fate == 3, "rewrote_tool_result_to_vault_set"), F.when(fate == 2, "rewrote_calendar_write_tool_result"), F.when(fate == 1, "rewrote_tool_result_to_lower_tier_tool"),
    ]
    said = F.when(whole.isNotNull(), new_text).when(fate == 3, VAULT_RESULT[0]).when(fate == 2, CALENDAR_RESULT[0]).when(claim, texts.get("replaced_l4_future_storage_claim", "")).when(shown, token).otherwise(F.col("text"))
    tool = F.when(vault, "set").when(call == "downgraded_higher_tier_tool", drop_in).when(fate == 3, VAULT_RESULT[1]).when(fate == 2, CALENDAR_RESULT[1]).when(fate == 1, F.col("_fate_tool")).otherwise(F.col("tool"))
    write = F.concat(F.lit("cat > "), F.regexp_extract("command", T.CALENDAR_FILE, 0))
    place = F.col(order).cast("decimal(20,3)")
    links = {"call_id": F.when(kept, F.col("call_id")), "ref": F.col("ref")} if linked else {}
    own = {
        order: place, "role": F.col("role"), "kind": F.col("kind"), "text": said, "tool": tool, "path": F.when(emptied, "").otherwise(F.col("path")),
        "command": F.when(call == "replaced_calendar_ls_with_visible_write", write).when(emptied, "").otherwise(F.col("command")),
        "has_call": F.col("has_call") & kept, "granted": F.col("granted") | approve, "declared": F.col("declared") & ~vault, "exact": F.col("exact") | vault,
        "request_valid": F.col("request_valid"), "resolution_valid": F.col("resolution_valid"), **links,
        "repairs": F.array_sort(F.array_distinct(F.array_compact(F.array(*done)))), "removed": F.coalesce(fate == 4, F.lit(False)),
    }

    def added(when: Column, step: float, role: str, kind: str = "", text: str = "", tool: str = "", command: Column | None = None, of: str = "") -> Column:
        """A row beside a row of ``when``, else null; a call and its result share an id made of ``of`` and the row's place."""
        is_call, number, nothing = role == "assistant", F.concat(F.lit(f"{of}-"), F.col(order).cast("string")), F.lit(None).cast("string")
        ids = {"call_id": number if is_call else nothing, "ref": number if role == "toolResult" else nothing} if linked else {}
        row = {
            order: (place + F.lit(step).cast("decimal(20,3)")).cast("decimal(20,3)"), "role": F.lit(role), "kind": F.lit(kind), "text": F.lit(text), "tool": F.lit(tool), "path": F.lit(""),
            "command": F.lit("") if command is None else command, "has_call": F.lit(is_call), "granted": F.lit(True), "declared": F.lit(False), "exact": F.lit(True),
            "request_valid": F.lit(kind == "exec.approval.requested"), "resolution_valid": F.lit(kind == "exec.approval.resolved"), **ids, "repairs": none, "removed": F.lit(False),
        }
        return F.when(when, F.struct(*[c.alias(n) for n, c in row.items()]))

    rows = F.array(
        F.struct(*[c.alias(n) for n, c in own.items()]),
        added(approve, -0.4, "custom", "exec.approval.requested"),
        added(approve, -0.3, "custom", "exec.approval.resolved"),
        added(reread, -0.6, "assistant", text=texts.get("inserted_resource_reread", ""), tool="read", of="reread"),
        added(reread, -0.5, "toolResult", of="reread"),
        added(delete, 0.1, "assistant", tool="exec", command=F.concat(F.lit("rm -f "), file), of="delete"),
        added(delete, 0.2, "toolResult", text="(no output)", of="delete"),
    )
    return r.select(*by, F.inline(F.array_compact(rows)))


def repair_until_stable(rows: DataFrame, held: DataFrame, by: list[str], order: str, refusal: str, texts: dict[str, str], rules: Callable[[], dict[str, Column]], checkpoint: Callable[[DataFrame], DataFrame], most: int = 3, lower: dict[str, str] | None = None) -> tuple[DataFrame, list[int]]:
    """Gates and repairs in turn, until a pass finds as much as the one before, or nothing, or ``most`` passes are done.

    ``rows`` are as ``repair`` returns them; only counts come to the driver.
    Returns the rows and the number of hits before each pass and at the end.
    """
    found: list[int] = []
    for n in range(most + 1):
        state = gate_state(rows.join(held, by).withColumn("args", F.concat_ws(" ", "path", "command", "text")), by, order, refusal)
        hits = checkpoint(gate_hits(state, by, order, rules()))
        found.append(hits.count())
        if n == most or not found[-1] or found[-2:-1] == found[-1:]:
            break
        rows = checkpoint(repair(state, hits, by, order, texts, lower).drop("repairs"))
    return rows, found


def triage(rule: Column) -> Column:
    """Whether an issue is repaired by rule or needs a person or model."""
    return F.when(rule.isin(*REPAIRABLE), "deterministic").otherwise("assisted")
