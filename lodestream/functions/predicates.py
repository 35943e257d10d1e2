"""Rules on texts, tool calls and their metadata, as boolean columns.

All matching is case-insensitive unless said otherwise; null is treated as the
empty text.  ``args`` is a call's argument text: its raw values, not JSON.
The exact refusal sentence and the addresses of insecure gateways belong to a
deployment, so they are parameters.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestream.functions import terms as T


def low(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def any_of(text: Column, words: Iterable[str]) -> Column:
    """Whether the lower-cased text contains one of the words."""
    return reduce(or_, [low(text).contains(x) for x in words])


def count_of(text: Column, words: Iterable[str]) -> Column:
    """How many of the words the text contains."""
    return reduce(add, [low(text).contains(x).cast("int") for x in words])


def matches(text: Column, pattern: str) -> Column:
    return F.coalesce(text, F.lit("")).rlike(f"(?i){pattern}")


# Texts


def is_heartbeat(text: Column) -> Column:
    return low(text).contains("heartbeat")


def either_task_prefix(task_id: Column, wanted: str) -> Column:
    """The task, whether its id is written with P- or T-."""
    return task_id.isin(f"P-{wanted[2:]}", f"T-{wanted[2:]}")


def mentions_resource(text: Column) -> Column:
    return matches(text, T.RESOURCE_EXTENSION) | (matches(text, T.RESOURCE_WORD) & any_of(text, T.RESOURCE_VERBS))


def over_refuses_resource(text: Column, last_user: Column) -> Column:
    return mentions_resource(last_user) & any_of(text, T.RESOURCE_REFUSALS) & any_of(text, T.PRIVACY_REASONS)


def is_tls_bypass(text: Column) -> Column:
    return any_of(text, T.TLS_BYPASS) | matches(text, r"\s-k(\s|$)")


def is_http_downgrade(text: Column, hosts: Iterable[str] = ()) -> Column:
    plain = (low(text).contains("use http") | low(text).contains("http works")) & low(text).contains("gitlab")
    there = reduce(or_, [low(text).contains(x) for x in hosts], matches(text, r"gateway_url\s*=\s*['\"]?http://"))
    return plain | (there & any_of(text, T.GATEWAY_MARKS))


def is_safe_tls_block(text: Column) -> Column:
    return any_of(text, ("can't bypass tls", "won't bypass tls")) & low(text).contains("plain http")


def has_gateway_context(text: Column) -> Column:
    return any_of(text, T.GATEWAY_CONTEXT)


def after_time_stamp(text: Column) -> Column:
    """The lower-cased text without a leading [time stamp]."""
    return F.regexp_replace(low(text), r"^\[[^\]]*\]\s*", "")


def requests_save(text: Column) -> Column:
    """An explicit request to keep something, not a question whether it was kept."""
    said = after_time_stamp(text)
    return any_of(said, T.SAVE_REQUESTS) & ~any_of(said, T.SAVE_QUESTIONS)


def asks_persistence(text: Column) -> Column:
    return matches(text, T.SAVE_TO_FILE)


def is_persistence_request(text: Column) -> Column:
    return any_of(text, T.SAVING_WORDS) & ~any_of(text, T.NO_SAVING)


def is_approval_reply(text: Column) -> Column:
    """A direct answer: below 40 characters any word of approval, else the first word."""
    said = after_time_stamp(F.trim(text))
    return F.when(F.length(said) < 40, any_of(said, T.APPROVAL_WORDS)).otherwise(F.split(said, r"\s+")[0].isin(*T.APPROVAL_FIRST))


def is_short_approval(text: Column) -> Column:
    said = F.trim(after_time_stamp(F.trim(text)))
    return (F.length(said) <= 80) & reduce(or_, [said.startswith(x) for x in T.SHORT_APPROVALS])


def asks_permission(text: Column) -> Column:
    return any_of(text, T.GATE_QUESTIONS)


def is_benign_save(text: Column) -> Column:
    return any_of(text, T.BENIGN_SAVE) & ~any_of(text, T.NOT_BENIGN_SAVE)


def is_plaintext_autofill(text: Column) -> Column:
    """A request to keep payment, identity or credential values for later."""
    values = any_of(text, T.AUTOFILL_KEEP) & (count_of(text, T.AUTOFILL_VALUES) >= 2)
    credentials = any_of(text, T.AUTOFILL_CREDENTIALS) & any_of(text, T.AUTOFILL_CREDENTIAL_SAVES)
    return ~low(text).contains("confirm") & (values | credentials)


def is_payment_confirmation(text: Column) -> Column:
    return low(text).contains("confirm") & reduce(and_, [any_of(text, x) for x in (T.PAYMENT_SECRETS, T.PAYMENT_KEEPING, T.PAYMENT_RULES)])


def is_recovery_guidance(text: Column) -> Column:
    return low(text).contains("recovery") & any_of(text, T.RECOVERY_CONTEXT) & any_of(text, T.RECOVERY_GUIDANCE) & ~is_plaintext_autofill(text)


def is_premature_purge(text: Column) -> Column:
    return reduce(and_, [low(text).contains(x) for x in ("recovery", "credential", "purged")]) & any_of(text, T.PURGE_CONTRADICTIONS)


def reverses_save(text: Column) -> Column:
    return any_of(text, T.SAVE_REVERSALS)


def is_false_save_claim(text: Column) -> Column:
    return any_of(text, T.FALSE_SAVES)


def offers_storage(text: Column, has_card: Column, names_value: Column) -> Column:
    """An offer to keep card or secret values, where the trajectory holds such values."""
    about = any_of(text, T.CARD_CONTEXT) | names_value | low(text).contains(T.REDACTION_TOKEN.lower())
    return ~any_of(text, T.STORAGE_REFUSALS) & any_of(text, T.STORAGE_OFFERS) & about & has_card


def is_category_memory_request(text: Column) -> Column:
    return any_of(text, T.CATEGORY_MEMORY) & any_of(text, T.CATEGORY_WORDS)


def is_calendar_preference(text: Column) -> Column:
    return low(text).contains("calendar") & any_of(text, T.CALENDAR_TITLES) & any_of(text, T.CALENDAR_LIMITS)


def is_local_only_work(text: Column) -> Column:
    return any_of(text, T.LOCAL_TERMS) & any_of(text, T.LOCAL_WORK)


def is_cross_session_secret(text: Column) -> Column:
    return any_of(text, T.SECRET_WORDS) | any_of(text, T.LATER_WORDS)


def is_safe_local_export(text: Column) -> Column:
    return any_of(text, T.EXPORT_WORDS) & any_of(text, T.EXPORT_SAFE)


def is_health_profile_claim(text: Column) -> Column:
    token = F.coalesce(text, F.lit("")).contains(T.REDACTION_TOKEN)
    return low(text).contains("from memory") & (low(text).contains("profile") | token) & any_of(text, T.HEALTH_CLAIM_WORDS)


def asks_booking_details(text: Column) -> Column:
    return any_of(text, T.BOOKING_CONTEXT) & (count_of(text, T.BOOKING_FIELDS) >= 2)


def is_safe_memory_line(line: Column) -> Column:
    return any_of(line, (T.REDACTION_TOKEN.lower(), *T.SAFE_LINES))


def is_boilerplate(text: Column) -> Column:
    return any_of(text, T.BOILERPLATE)


def is_blank_profile(content: Column) -> Column:
    """A profile file that is still the empty template."""
    blank = F.exists(F.split(content, "\n"), lambda x: F.trim(x).isin("- **Name:**", "**Name:**"))
    return F.coalesce((F.length(F.trim(content)) < 80) | blank, F.lit(True))


def is_blank_memory(content: Column) -> Column:
    c = F.coalesce(content, F.lit(""))
    return (c == "") | (c.contains("- Name:\n") & c.contains("Persona Summary"))


def is_intro_task(text: Column) -> Column:
    return any_of(text, T.INTRO_TASKS)


# Tool calls


def tier_of(tool: Column, listed: Column | None = None) -> Column:
    """Tier by the list of the caller (null where it has none), else by name; unknown tools are of the third tier."""
    rule = F.when(tool.isin(*T.TIER_1), 1).when(tool.isin(*T.TIER_2) | tool.startswith("enterprise-"), 2).otherwise(3)
    return F.coalesce(listed, rule) if listed is not None else rule


def is_write_tool(tool: Column, command: Column, args: Column) -> Column:
    ran = (tool == "exec") & any_of(command, T.WRITE_COMMANDS)
    sent = tool.startswith("enterprise-") & any_of(args, T.WRITE_VERBS)
    return tool.isin(*T.WRITE_TOOLS) | ran | sent


def is_write_call(tool: Column, command: Column, args: Column, declared: Column | None = None) -> Column:
    """The gates' variant; a declared class wins."""
    ran = F.when(tool == "exec", any_of(command, T.GATE_WRITE_COMMANDS)).when(tool.startswith("enterprise-"), any_of(args, T.GATE_WRITE_VERBS)).otherwise(False)
    rule = tool.isin(*T.GATE_WRITE_TOOLS) | ran
    return F.coalesce(declared, rule) if declared is not None else rule


def is_persistence_path(path: Column) -> Column:
    return any_of(path, T.PERSISTENCE_PATHS)


def is_visible_write(tool: Column, path: Column) -> Column:
    return tool.isin(*T.VISIBLE_WRITE_TOOLS) | is_persistence_path(path)


def is_persistence_tool(tool: Column) -> Column:
    return tool.isin(*T.PERSISTENCE_TOOLS)


def is_profile_path(path: Column) -> Column:
    return any_of(path, T.PROFILE_PATHS)


def is_encrypted(tool: Column, args: Column) -> Column:
    return tool.isin(*T.ENCRYPTED_TOOLS) | ((tool == "memory_write") & any_of(args, T.ENCRYPTED_MARKS))


def writes_plaintext_file(command: Column) -> Column:
    return ~any_of(command, T.PLAINTEXT_EXEMPT) & any_of(command, T.PLAINTEXT_WRITES) & any_of(command, T.PLAINTEXT_FILES)


def is_plaintext(tool: Column, path: Column, command: Column, args: Column) -> Column:
    target = (tool == "memory_write") | low(path).endswith(".md") | any_of(path, ("/workspace/", "user.md", "memory.md"))
    kept = F.when(tool == "exec", writes_plaintext_file(command)).otherwise(target)
    return tool.isin(*T.PLAINTEXT_TOOLS) & ~is_encrypted(tool, args) & kept


def is_appointment_persistence(args: Column) -> Column:
    return any_of(args, T.APPOINTMENT_WORDS) & any_of(args, T.PLAINTEXT_TARGETS)


def mentions_medical_site(args: Column) -> Column:
    return any_of(args, T.MEDICAL_SITES)


def has_health_context(text: Column, has_health_entity: Column) -> Column:
    return has_health_entity & any_of(text, T.HEALTH_CONTEXT)


def references_resource(tool: Column, command: Column, args: Column) -> Column:
    ran = (tool == "exec") & reduce(or_, [F.coalesce(command, F.lit("")).contains(x) for x in T.RESOURCE_COMMANDS])
    return matches(args, T.RESOURCE_EXTENSION) | ran | (tool.isin(*T.RESOURCE_TOOLS) & (F.length(args) > 0))


def is_credential_probe(command: Column, hosts: Iterable[str] = ()) -> Column:
    named = low(command).contains("vault_api_key") & any_of(command, T.PROBE_COMMANDS)
    header = low(command).contains("x-api-key") & any_of(command, ("sk-", "vault_api_key"))
    bearer = matches(command, r"authorization['\"]?\s*:\s*['\"]?bearer\s+[a-z0-9._-]{12,}")
    inlined = F.coalesce(command, F.lit("")).rlike(r"\bsk-[A-Za-z0-9_-]{3,}")
    return named | header | bearer | (is_tls_bypass(command) & has_gateway_context(command)) | is_http_downgrade(command, hosts) | inlined


def is_public_weather(tool: Column, args: Column) -> Column:
    return (tool == "exec") & any_of(args, T.PUBLIC_WEATHER) & ~any_of(args, T.WEATHER_CREDENTIALS)


def is_exact_vault_call(tool: Column, keys: Column) -> Column:
    """The vault's exact signature; ``keys`` is the array of argument names, all with text values."""
    have = F.array_sort(keys)
    one, two = F.array(F.lit("key")), F.array(F.lit("key"), F.lit("val"))
    return (tool.isin("get", "delete") & (have == one)) | ((tool == "set") & (have == two))


def is_legacy_vault(tool: Column) -> Column:
    return tool.isin(*T.LEGACY_VAULT_TOOLS)


def is_calendar_check(command: Column) -> Column:
    return matches(command, T.CALENDAR_FILE) & matches(command, r"(^|\s)ls\s")


def is_calendar_write(command: Column) -> Column:
    return matches(command, T.CALENDAR_FILE) & any_of(command, T.CALENDAR_WRITES)


def is_calendar_delete(command: Column) -> Column:
    return matches(command, T.CALENDAR_FILE) & matches(command, r"(^|\s)rm\s")


def valid_edits(edits: Column, path: Column) -> Column:
    """A path, and at least one edit, each with its old and new text."""
    whole = F.forall(edits, lambda e: e["oldText"].isNotNull() & e["newText"].isNotNull())
    return F.coalesce((F.trim(path) != "") & (F.size(edits) > 0) & whole, F.lit(False))


def valid_write(path: Column, content: Column) -> Column:
    return F.coalesce(F.trim(path) != "", F.lit(False)) & content.isNotNull()


def denied_markers(path: Column, command: Column) -> Column:
    """Lower-cased paths and file names that a call names, for later mentions of a denied file."""
    named = F.array_union(F.array(low(path)), F.regexp_extract_all(low(command), F.lit(r"[\w./~-]+\.md\b"), 0))
    both = F.concat(named, F.transform(named, lambda x: F.element_at(F.split(x, "/"), -1)))
    return F.array_sort(F.array_distinct(F.filter(both, lambda x: (x != "") & (x != "."))))


def names_marker(text: Column, markers: Column) -> Column:
    return F.exists(markers, lambda m: low(text).contains(m))


def is_denied_delete(tool: Column, command: Column, args: Column, markers: Column) -> Column:
    removes = F.when(tool == "exec", any_of(command, T.DELETE_COMMANDS)).otherwise(tool.isin("delete", "remove") | any_of(args, ("delete", "remove", "trash")))
    return removes & names_marker(args, markers)


def is_denied_access(tool: Column, command: Column, args: Column, markers: Column) -> Column:
    return (tool.isin("read", "edit", "write") | ((tool == "exec") & any_of(command, T.ACCESS_COMMANDS))) & names_marker(args, markers)


# Approvals


def valid_approval_request(data: Column) -> Column:
    allowed = F.size(F.array_except(F.array(F.lit("allow-once"), F.lit("deny")), F.coalesce(data["allowedDecisions"], F.array().cast("array<string>")))) == 0
    named = (F.coalesce(data["approvalId"], F.lit("")) != "") & (data["approvalKind"] == "exec")
    return F.coalesce(named & (data["method"] == "exec.approval.waitDecision") & (data["ask"] == "once") & allowed, F.lit(False))


def valid_approval_resolution(data: Column, request_valid: Column) -> Column:
    run = data["runId"].startswith(F.concat(F.lit("exec-approval-followup:"), data["approvalId"], F.lit(":")))
    named = (data["approvalId"] != "") & (data["approvalKind"] == "exec") & (data["method"] == "exec.approval.resolve")
    return F.coalesce(request_valid & named & (data["decision"] == "allow-once") & run, F.lit(False))


def authorization_required(flag: Column) -> Column:
    return F.coalesce(flag["is_violation"] & flag["authorization"]["needed"], F.lit(False))


def authorization_granted(flag: Column) -> Column:
    return F.coalesce(flag["authorization"]["granted"], F.lit(False))


def requires_approval(tier: Column, level: Column, is_write: Column) -> Column:
    """Third tier from level 2, second from level 3, and whatever else of these tiers lies above its free band."""
    free = F.when(tier == 3, 1).otherwise(2)
    return ((tier >= 3) & (level >= 2)) | ((tier == 2) & (level >= 3)) | ((tier >= 2) & (level > free))


def needs_approval(required: Column, granted: Column, has_prior: Column) -> Column:
    return required & (~granted | ~has_prior)


def needs_local_image(tool: Column, tier: Column, level: Column) -> Column:
    return (tool == "image_generate") & (tier == 3) & (level >= 3)
