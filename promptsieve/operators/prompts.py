"""User prompts out of nested records.

The walk goes down a record one nesting level at a time, inside the record's
own row.  It is a fold whose state holds the objects and lists of the current
level, each with the ids inherited from above and its place in the document,
and the prompts found so far.  Nothing is joined, grouped or shuffled, and the
source is read once, however deep records go.  Parts of a record without a
field naming a role and a field for content are left out, since no prompt can
come from them.

A record is tagged once (`jsontext.tagged`) and stays so until its prompts are
given out, so a value tells its type without being parsed into another form.
Contents have no limit but that of a column value, 2 GB for the whole record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptsieve.functions.jsontext import (
    given,
    is_container,
    is_truthy,
    last_key_wins,
    plain,
    read_json,
    spaced_json,
    tag,
    tagged,
    tagged_elements,
    tagged_struct,
    untagged,
)

# --- Fixed values: field names, in order of preference ------------------------

USER_ROLES = ("user", "human", "end_user")
ROLE_KEYS = ("role", "sender_role", "senderRole", "author", "sender")
EVENT_KEYS = ("event_id", "eventId")
CONVERSATION_KEYS = ("conversation_id", "conversationId")
NESTED_CONVERSATION_KEYS = ("id", "conversation_id", "conversationId")
MESSAGE_KEYS = ("message_id", "messageId")
OWN_MESSAGE_KEYS = ("message_id", "messageId", "id")
USER_KEYS = ("user_id", "userId", "actor_id", "actorId", "account_id", "accountId")
EMAIL_KEYS = ("user_email", "userEmail", "email", "email_address", "emailAddress")
CREATED_KEYS = ("created_at", "createdAt", "create_time", "createTime", "timestamp", "time", "created")
PERSON_KEYS = ("user", "actor", "author", "sender")
PERSON_ID_KEYS = ("id", "user_id", "userId", "email")
CONTENT_KEYS = ("content", "text", "prompt", "input")
NORMAL_PARTS = ("parts", "text", "value")
TEXT_PARTS = ("value", "text", "parts")

CONTEXT_FIELDS = ("event_id", "conversation_id", "message_id", "user_id", "user_email", "created_at")
PROMPT_FIELDS = CONTEXT_FIELDS + ("content_kind", "content", "raw")

# JSON nested deeper than this is not read at all: it is what the JSON reader takes.
MAX_NESTING = 1000

_ID_KEYS = EVENT_KEYS + CONVERSATION_KEYS + OWN_MESSAGE_KEYS + USER_KEYS + EMAIL_KEYS + CREATED_KEYS
_PERSON = tagged_struct(*PERSON_ID_KEYS, *EMAIL_KEYS, "role", "type")
_PERSONS = {p: _PERSON for p in PERSON_KEYS}
# While walking down: ids and roles.  For a prompt's own object: ids and content.
_WALKED = tagged_struct(*_ID_KEYS, "conversation", "role", "sender_role", "senderRole", **_PERSONS)
_SPOKEN = tagged_struct(*_ID_KEYS, *CONTENT_KEYS, "message", **_PERSONS)


def _path(node: str, *keys: str) -> str:
    return ".".join([node, *map(tag, keys)])


def _first_given(node: str, keys, persons=(), person_keys=()) -> list[str]:
    paths = [_path(node, k) for k in keys] + [_path(node, p, k) for p in persons for k in person_keys]
    return [given(p) for p in paths]


# Where each field of a prompt is looked for in the prompt's own object.
_OWN = {
    "event_id": (EVENT_KEYS,),
    "conversation_id": (CONVERSATION_KEYS,),
    "message_id": (OWN_MESSAGE_KEYS,),
    "user_id": (USER_KEYS, PERSON_KEYS, PERSON_ID_KEYS),
    "user_email": (EMAIL_KEYS, PERSON_KEYS, EMAIL_KEYS),
    "created_at": (CREATED_KEYS,),
}


def _is_user(node: str) -> str:
    """SQL: whether an object's role, the first its fields name, is a user's.

    The direct fields come first; author and sender are asked only if those
    leave nothing at all (an empty last field is something).
    """
    role, sender_role, last = (_path(node, k) for k in ("role", "sender_role", "senderRole"))
    author, author_type, sender = _path(node, "author", "role"), _path(node, "author", "type"), _path(node, "sender", "role")
    named = ", ".join(f"'{tag(r)}'" for r in USER_ROLES)
    return f"""coalesce(lower(CASE
        WHEN {is_truthy(role)} THEN {role}
        WHEN {is_truthy(sender_role)} THEN {sender_role}
        WHEN {given(last)} IS NOT NULL THEN {last}
        WHEN {is_truthy(author)} THEN {author}
        WHEN {given(author_type)} IS NOT NULL THEN {author_type}
        WHEN {is_truthy(sender)} THEN {sender}
        ELSE {_path(node, 'sender', 'type')} END) IN ({named}), false)"""


def _inherit(node: str) -> str:
    """SQL: context for what lies below `node`; what is set further out stays."""
    conversation = _path(f"{node}.v", "conversation")
    nested = read_json(conversation, tagged_struct(*NESTED_CONVERSATION_KEYS))
    named = f"""CASE WHEN startswith({conversation}, 's') THEN {conversation}
        WHEN startswith({conversation}, '{{')
        THEN coalesce({', '.join(given(_path(nested, k)) for k in NESTED_CONVERSATION_KEYS)}) END"""
    fields = []
    for name, spec in _OWN.items():
        paths = _first_given(f"{node}.v", *((MESSAGE_KEYS,) if name == "message_id" else spec))
        if name == "conversation_id":
            paths.append(named)
        fields.append(f"'{name}', coalesce({node}.c.{name}, {', '.join(paths)})")
    return f"named_struct({', '.join(fields)})"


def _own_or_inherited(node: str, name: str) -> str:
    own = f"coalesce({', '.join(_first_given(f'{node}.v', *_OWN[name]))})"
    return f"if({is_truthy(own)}, {own}, {node}.c.{name})"


def _relevant(text: str) -> str:
    def any_key(keys) -> str:
        return "(" + " OR ".join(f"contains({text}, '\"{tag(k)}\"')" for k in keys) + ")"

    return f"({any_key(ROLE_KEYS)} AND {any_key(CONTENT_KEYS + ('message',))})"


def _open_nodes(level: str) -> str:
    """SQL: the nodes of a level, with the context for what lies below them and
    whether they speak for a user."""
    read = f"""transform({level}, n -> named_struct('t', n.t, 'o', n.o, 'c', n.c,
        'v', if(startswith(n.t, '{{'), {read_json('n.t', _WALKED)}, null)))"""
    return f"""transform({read}, n -> named_struct('t', n.t, 'o', n.o, 'c', {_inherit('n')}, 'is_user', {_is_user('n.v')}))"""


def _users(nodes: str) -> str:
    return f"""transform(filter({nodes}, n -> n.is_user),
        n -> named_struct('t', n.t, 'o', n.o, 'c', n.c))"""


def _children(nodes: str) -> str:
    """SQL: the next level, in document order."""
    below = f"""filter(transform({tagged_elements('n.t')}, (t, i) -> named_struct('t', t, 'i', i)),
        p -> {is_container('p.t')} AND {_relevant('p.t')})"""
    return f"""flatten(transform({nodes}, n -> transform({below},
        p -> named_struct('t', p.t, 'o', concat(n.o, array(p.i)), 'c', n.c))))"""


def _contents(nodes: str) -> str:
    """SQL: (n, content) for each node, with nothing for null.

    The first content field there is counts, even if it is null; an object is
    replaced by its parts, text or value; a list of one part by that part.
    """
    message = _path("n.v", "message")
    picks = ", ".join(_path("n.v", k) for k in CONTENT_KEYS)
    picked = f"""transform({nodes}, n -> named_struct('n', n,
        'x', coalesce({picks}, if(startswith({message}, 's'), {message}, null))))"""
    read = f"""transform({picked}, p -> named_struct('n', p.n, 'x', p.x,
        'v', if(startswith(p.x, '{{'), {read_json('p.x', tagged_struct(*NORMAL_PARTS))}, null)))"""
    normal = f"""transform({read}, p -> named_struct('n', p.n,
        'x', coalesce({', '.join(_path('p.v', k) for k in NORMAL_PARTS)}, p.x),
        'items', if(startswith({_path('p.v', 'parts')}, '['), {read_json(_path('p.v', 'parts'), 'array<string>')}, null)))"""
    return f"""filter(transform({normal}, p -> named_struct('n', p.n,
        'content', if(size(p.items) = 1, p.items[0], p.x))), p -> p.content <> 'n')"""


def _prompts(users: str) -> str:
    """SQL: the prompts of the nodes that speak for a user and hold content, all
    values tagged."""
    read = f"""transform({users}, n -> named_struct('t', n.t, 'o', n.o, 'c', n.c, 'v', {read_json('n.t', _SPOKEN)}))"""
    fields = ", ".join(f"'{f}', {_own_or_inherited('x.n', f)}" for f in CONTEXT_FIELDS if f != "message_id")
    return f"""transform({_contents(read)}, x -> named_struct('message_id', {_own_or_inherited('x.n', 'message_id')},
        'content', x.content, 'o', x.n.o, {fields}, 'raw', x.n.t))"""


def _same(field: str) -> str:
    return f"p.{field} <=> get(_sorted, i - 1).{field}"


def _walk(json: str) -> str:
    """SQL: the nodes of a tagged record that speak for a user, with their context."""
    no_ids = ", ".join(f"'{f}', cast(null AS string)" for f in CONTEXT_FIELDS)
    root = f"""array(named_struct('t', {json}, 'o', cast(array() AS array<int>),
        'c', named_struct({no_ids})))"""
    state = f"""named_struct('nodes', {_open_nodes(root)}, 'found',
        filter(array(named_struct('t', {json}, 'o', cast(array() AS array<int>), 'c', named_struct({no_ids}))), n -> false))"""
    down = f"""named_struct('nodes', {_open_nodes(_children('s.nodes'))},
        'found', concat(s.found, {_users('s.nodes')}))"""
    is_open = f"{is_container(json)} AND {_relevant(json)}"
    return f"""if({is_open},
        aggregate({_levels(json)}, {state}, (s, i) -> if(size(s.nodes) = 0, s, {down}), s -> s.found), null)"""


def _levels(json: str) -> str:
    """SQL: a number for each level a container can have: no more than brackets."""
    brackets = f"2 * length({json}) - length(replace({json}, '{{')) - length(replace({json}, '['))"
    return f"sequence(1, least({MAX_NESTING}, {brackets}))"


_KIND = """CASE WHEN startswith(p.content, 's') THEN 'STRING' WHEN startswith(p.content, '{') THEN 'OBJECT'
    WHEN startswith(p.content, '[') THEN 'ARRAY' WHEN p.content IN ('true', 'false') THEN 'BOOLEAN' ELSE 'NUMBER' END"""


def extract_prompts(records: DataFrame, json: str = "record_json") -> DataFrame:
    """Add `prompts`, the array of user prompts of each record in document order.

    Each prompt has `PROMPT_FIELDS`: ids and times as text, the content as
    `content` (plain text if `content_kind` is STRING, else JSON text) and
    the object it came from as `raw`.  A prompt whose message id and content
    repeat an earlier one of the same record is left out; the number 1 and the
    string "1" are different ids.
    """
    last_key_wins(records.sparkSession)
    kept = records.columns
    unique = f"""filter(_sorted, (p, i) -> i = 0 OR p.message_id IS NULL
        OR NOT ({_same('message_id')} AND {_same('content')}))"""
    shown = {f: plain(f"p.{f}") for f in PROMPT_FIELDS} | {"content_kind": _KIND, "raw": untagged("p.raw")}
    ordered = f"array_sort(transform({unique}, p -> named_struct('o', p.o, 'p', p)))"
    fields = ", ".join(f"'{f}', {shown[f]}" for f in PROMPT_FIELDS)
    in_order = f"transform({ordered}, x -> transform(array(x.p), p -> named_struct('o', p.o, {fields}))[0])"
    nothing = f"cast(array() AS array<struct<o:array<int>,{','.join(f'{f}:string' for f in PROMPT_FIELDS)}>>)"
    # Records without a role or content are left as they are.
    marked = f"if({is_container(json)}, {tagged(json)}, null)"
    return (
        records.select("*", F.expr(marked).alias("_tagged"))
        .select(*kept, F.expr(_walk("_tagged")).alias("_users"))
        .select(*kept, F.expr(f"array_sort({_prompts('_users')})").alias("_sorted"))
        .select(*kept, F.expr(f"coalesce({in_order}, {nothing})").alias("prompts"))
    )


def prompt_rows(extracted: DataFrame) -> DataFrame:
    """One row per prompt: the record's columns, `prompt_no` and `PROMPT_FIELDS`."""
    kept = [c for c in extracted.columns if c != "prompts"]
    # An outer explode, because Spark would copy the whole walk into a filter
    # on the array's size ahead of an inner one.
    rows = extracted.select(*kept, F.posexplode_outer("prompts").alias("prompt_no", "_prompt"))
    rows = rows.where(F.col("prompt_no").isNotNull())
    return rows.select(*kept, "prompt_no", *(F.col(f"_prompt.{f}").alias(f) for f in PROMPT_FIELDS))


def prompt_text(content_kind: str = "content_kind", content: str = "content") -> Column:
    """A prompt's content as one text: parts on lines of their own, wrapped
    values unwrapped, and any other object as JSON with sorted keys.

    A fold over nesting levels: the state is the list of parts in order, and
    each turn replaces every container by what it holds, until none is left.
    """
    held = ", ".join(_path("v", k) for k in TEXT_PARTS)
    bare = untagged("x")
    other = f"coalesce({spaced_json(bare)}, {bare})"
    opened = f"""transform(array({read_json('x', tagged_struct(*TEXT_PARTS))}), v -> coalesce({held}, concat('s', {other})))"""
    step = f"""CASE WHEN startswith(x, 's') THEN array(x)
        WHEN x IN ('n', '[]') THEN array('s')
        WHEN startswith(x, '[') THEN {read_json('x', 'array<string>')}
        WHEN startswith(x, '{{') THEN {opened}
        ELSE array(concat('s', x)) END"""
    # Whether a container was left is asked of the list the turn began with.
    turn = f"if(s.open, named_struct('items', flatten(transform(s.items, x -> {step})), 'open', exists(s.items, x -> NOT startswith(x, 's'))), s)"
    start = f"transform(array({tagged(content)}), t -> named_struct('items', array(t), 'open', true))[0]"
    folded = f"aggregate({_levels_of(content)}, {start}, (s, i) -> {turn}, s -> array_join(transform(s.items, x -> substring(x, 2)), '\\n'))"
    return F.expr(f"if({content_kind} IN ('ARRAY', 'OBJECT'), {folded}, {content})")


def _levels_of(content: str) -> str:
    """SQL: levels of the content, and two turns to take down what is in the last."""
    return f"concat({_levels(content)}, array(0, 0))"
