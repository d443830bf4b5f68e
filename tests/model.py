"""A plain model of the rules for differential tests: slow, one text at a time,
and built on other means than the Spark operators (offsets and bisection for
windows, an explicit stack for the walk)."""

from __future__ import annotations

import json
import re
from bisect import bisect_left, bisect_right

from promptsieve.functions import catalogue as C
from promptsieve.operators import prompts as K


class Text:
    def __init__(self, text: str):
        self.text = text
        found = [(m.start(), m.group()) for m in re.finditer(r"\S+", text)]
        self.starts = [at for at, _ in found]
        self.words = [word for _, word in found]

    def window(self, start: int, end: int) -> str:
        first = bisect_right(self.starts, start) - 1
        last = bisect_left(self.starts, end) - 1
        return " ".join(self.words[max(first - 8, 0) : last + 9])

    def has(self, term: str):
        return re.search(r"\b" + re.escape(term) + r"\b", self.text, re.I)


def passes_luhn(number: str) -> bool:
    digits = [int(c) for c in number if c.isdecimal()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def detections(text: str) -> list[tuple]:
    """(category, score, confidence, reason, start, end, evidence) in order."""
    t = Text(text)

    def plain(rules):
        for rule in rules:
            flags = 0 if rule.kind == "card" else re.I | re.S
            for pattern in rule.patterns:
                for m in re.finditer(pattern.regex, text, flags):
                    evidence = t.window(*m.span())
                    if rule.kind == "card" and not passes_luhn(m.group()):
                        continue
                    if rule.kind == "contact" and not any(map(Text(evidence).has, C.CONTACT_CONTEXT_TERMS)):
                        continue
                    yield (rule.category, rule.score, rule.confidence, rule.reason, *m.span(), evidence)

    def phi():
        present = [term for term in C.PHI_TERMS if t.has(term)]
        if present:
            strong = len(present) > 1 or present[0] in C.PHI_STRONG_TERMS
            score, confidence = C.PHI_STRONG if strong else C.PHI_WEAK
            span = t.has(present[0]).span()
            yield (C.PHI_CATEGORY, score, confidence, C.PHI_REASON, *span, t.window(*span))

    def client():
        groups = (C.CLIENT_TERMS, C.SENSITIVE_DOCUMENT_TERMS, C.SENSITIVE_DATA_TERMS, C.ANALYSIS_TERMS)
        hits = [any(map(t.has, terms)) for terms in groups]
        if hits[0] and any(hits[1:]):
            category, score, confidence, reason = C.CLIENT_STRONG if hits[1] or hits[2] else C.CLIENT_WEAK
            labels = [name for name, hit in zip(C.CLIENT_GROUP_LABELS, hits) if hit and t.has(name)]
            span = t.has(labels[0]).span() if labels else (None, None)
            evidence = t.window(*span) if labels else text[:260]
            yield (category, score, confidence, reason, *span, evidence)

    return [
        *plain(C.PERSONAL_DATA_RULES), *phi(), *plain(C.INTERNAL_POLICY_RULES), *client(),
        *plain(C.USAGE_POLICY_RULES),
    ]


def verdict(text: str) -> dict:
    found = detections(text)
    names = sorted({d[0] for d in found})
    score = min(100, max(d[1] for d in found) + min(10, 2 * len(names) - 2)) if found else 0
    level = next((name for name, floor in C.LEVEL_FLOORS if score >= floor), "none")
    confidences = {d[2] for d in found}
    evidence = list(dict.fromkeys(d[6] for d in found if d[6]))
    return {
        "risk_score": score,
        "risk_level": level,
        "confidence": next((c for c in C.CONFIDENCES if c in confidences), "none"),
        "needs_human_review": bool(found),
        "categories": "; ".join(names),
        "reasons": " | ".join(dict.fromkeys(d[3] for d in found)),
        "matched_evidence": " | ".join(evidence[:5]),
    }


def as_text(value):
    """How an id or time of any JSON type is written as text."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def role_of(node: dict):
    a, b, c = (node.get(k) for k in ("role", "sender_role", "senderRole"))
    role = a or b or c
    for person in ("author", "sender"):
        if role is None and isinstance(node.get(person), dict):
            role = node[person].get("role") or node[person].get("type")
    return role.lower() if isinstance(role, str) else None


def is_response(record) -> bool:
    if not isinstance(record, dict):
        return False
    message = record.get("message")
    return role_of(message if isinstance(message, dict) else record) in ("assistant", "model")


def lookup(node: dict, keys, nested_keys=()):
    places = [node.get(k) for k in keys]
    for person in K.PERSON_KEYS if nested_keys else ():
        if isinstance(node.get(person), dict):
            places += [node[person].get(k) for k in nested_keys]
    return next((v for v in places if v is not None), None)


OWN = {
    "event_id": (K.EVENT_KEYS,),
    "conversation_id": (K.CONVERSATION_KEYS,),
    "message_id": (K.OWN_MESSAGE_KEYS,),
    "user_id": (K.USER_KEYS, K.PERSON_ID_KEYS),
    "user_email": (K.EMAIL_KEYS, K.EMAIL_KEYS),
    "created_at": (K.CREATED_KEYS,),
}


def context_of(node: dict, outer: dict) -> dict:
    inner = {name: lookup(node, *spec) for name, spec in OWN.items()}
    inner["message_id"] = lookup(node, K.MESSAGE_KEYS)
    conversation = node.get("conversation")
    if inner["conversation_id"] is None and isinstance(conversation, dict):
        inner["conversation_id"] = lookup(conversation, K.NESTED_CONVERSATION_KEYS)
    elif inner["conversation_id"] is None and isinstance(conversation, str):
        inner["conversation_id"] = conversation
    return {k: outer[k] if outer.get(k) is not None else inner[k] for k in OWN}


def content_of(node: dict):
    key = next((k for k in K.CONTENT_KEYS if k in node), None)
    if key is None:
        return node["message"] if isinstance(node.get("message"), str) else None
    content = node[key]
    if isinstance(content, dict):
        part = next((k for k in K.NORMAL_PARTS if k in content), None)
        if part is not None:
            content = content[part]
            if part == "parts" and isinstance(content, list) and len(content) == 1:
                content = content[0]
    return content


def prompts(record) -> list[dict]:
    found, seen, stack = [], set(), [(record, {})]
    while stack:
        value, outer = stack.pop()
        if isinstance(value, list):
            stack += [(item, outer) for item in reversed(value)]
        if not isinstance(value, dict):
            continue
        context = context_of(value, outer)
        content = content_of(value)
        if role_of(value) in K.USER_ROLES and content is not None:
            row = {name: lookup(value, *spec) or context[name] for name, spec in OWN.items()}
            mark = (json.dumps(row["message_id"]), repr(content))
            if row["message_id"] is None or mark not in seen:
                found.append({k: as_text(v) for k, v in row.items()} | {"prompt": text_of(content)})
            seen.add(mark)
        stack += [(item, context) for item in reversed(value.values())]
    return found


def text_of(content) -> str:
    if content is None or isinstance(content, str):
        return content or ""
    if isinstance(content, list):
        return "\n".join(map(text_of, content))
    if isinstance(content, dict):
        part = next((k for k in K.TEXT_PARTS if k in content), None)
        if part is not None:
            return text_of(content[part])
    return json.dumps(content, ensure_ascii=False, sort_keys=True)
