"""DDL text as column expressions: tokens first, then statements, tables, clauses and types.

``tokens`` cuts a statement into words, punctuation and quoted parts; comments go (the text
of ``/*!40101 ... */`` stays, for servers run it).  Quoted parts are written as hex between
their quotes, so no comma, bracket or key word inside a name, a label or a comment can be taken
for syntax; names and labels are read back from the hex.  Everything else here works on
that canonical text, whose tokens are one space apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUE: comments, strings, back-quoted names, punctuation, words.
TOKEN = (r"(/\*!\d*|/\*(?s:.*?)(?:\*/|$)|\*/|--(?=\s|$)[^\n]*|#[^\n]*"
         r"|'(?:[^'\\]++|\\(?s:.)|'')*+'|\"(?:[^\"\\]++|\\(?s:.)|\"\")*+\"|`(?:[^`]++|``)*+`"
         r"|[(),;.=]|[^\s'\"`(),;.=/#\-]+|[/#\-])")
COMMENT = r"^(?:/\*|\*/|--\s|--$|#)"
_N = r"(?:`[0-9A-F]*`|[^\s`'\(\),;.=]+)"              # a name, quoted or not
_TABLE = rf"(?:({_N}) \. )?({_N})"
# FIXED VALUE: statements about tables, up to the first table's name.
STATEMENT = rf"(?i)^(ALTER|CREATE|DROP|TRUNCATE|RENAME)(?: (?:IGNORE|ONLINE|OFFLINE|TEMPORARY|OR|REPLACE))* TABLES?(?: IF NOT EXISTS| IF EXISTS)? {_TABLE}"
# FIXED VALUE: words after ADD, DROP or an opening bracket that name no column.
NO_COLUMN = r"(?!(?:INDEX|KEY|PRIMARY|UNIQUE|CONSTRAINT|FULLTEXT|SPATIAL|FOREIGN|CHECK|PARTITION|COLUMN|IF|LIKE)\b)"
_TYPE = r"([A-Za-z]\w*(?: PRECISION| VARYING)?(?: \( [^()]* \))?(?: (?:UNSIGNED|SIGNED|ZEROFILL))*)"
_IF = r"(?:IF (?:NOT )?EXISTS )?"
# FIXED VALUES: column clauses: action, pattern, groups of (column, new name, type).
COLUMN_CLAUSES = [
    ("add", rf"(?i)^ADD (?:COLUMN )?{_IF}{NO_COLUMN}({_N}) {_TYPE}", 1, None, 2),
    ("drop", rf"(?i)^DROP (?:COLUMN )?{_IF}{NO_COLUMN}({_N})", 1, None, None),
    ("modify", rf"(?i)^MODIFY (?:COLUMN )?{_IF}({_N}) {_TYPE}", 1, None, 2),
    ("change", rf"(?i)^CHANGE (?:COLUMN )?{_IF}({_N}) ({_N}) {_TYPE}", 1, 2, 3),
    ("rename", rf"(?i)^RENAME COLUMN ({_N}) TO ({_N})", 1, 2, None)]
_COLUMNS = r"(?: USING \w+)? \( ((?:[^()]|\([^()]*\))*) \)"
_CONSTRAINT = rf"(?:CONSTRAINT (?:(?!PRIMARY|UNIQUE){_N} )?)?"
# FIXED VALUES: key clauses: action, kind, pattern, groups of (key name, columns).
KEY_CLAUSES = [
    ("add_key", "PRI", rf"(?i)^ADD {_CONSTRAINT}PRIMARY KEY{_COLUMNS}", None, 1),
    ("add_key", "UNI", rf"(?i)^ADD {_CONSTRAINT}UNIQUE(?: KEY| INDEX)?(?: {_IF}({_N}))?{_COLUMNS}", 1, 2),
    ("add_key", "MUL", rf"(?i)^ADD (?:INDEX|KEY)(?: {_IF}({_N}))?{_COLUMNS}", 1, 2),
    ("drop_key", "PRI", r"(?i)^DROP PRIMARY KEY", None, None),
    ("drop_key", "", rf"(?i)^DROP (?:INDEX|KEY|CONSTRAINT) {_IF}({_N})", 1, None)]
PRIMARY = "PRIMARY"
ACTION = ("struct<action:string,column:string,new_name:string,type:string,place:string,anchor:string,"
          "key_name:string,key_kind:string,key_columns:array<string>>")
# Marks of top-level syntax: clause comma, list comma, opening and closing bracket.
CLAUSE, ITEM, OPEN, CLOSE = "\x01", "\x02", "\x03", "\x04"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` mentions it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def tokens(query) -> Column:
    """The tokens of a statement without comments; quoted parts as hex between their quotes."""
    found = F.regexp_extract_all(F.coalesce(_c(query), F.lit("")), F.lit(TOKEN), F.lit(1))

    def token(t: Column) -> Column:
        inner = F.substr(t, F.lit(2), F.length(t) - 2)
        text = F.regexp_replace(F.replace(inner, F.lit("''"), F.lit("\\'")), r"\\(.)", "$1")
        return (F.when(t.rlike(COMMENT), F.lit(None).cast("string"))
                .when(t.startswith("`"), F.concat(F.lit("`"), F.hex(F.replace(inner, F.lit("``"), F.lit("`"))), F.lit("`")))
                .when(t.startswith("'") | t.startswith('"'), F.concat(F.lit("'"), F.hex(text), F.lit("'")))
                .otherwise(t))
    return F.array_compact(F.transform(found, token))


def canonical(query) -> Column:
    """A statement's tokens, one space apart."""
    return F.array_join(tokens(query), " ")


def marked(query) -> Column:
    """The canonical text of a DDL statement with its top-level commas and brackets marked ('' for other statements)."""
    q = _c(query)
    start = F.struct(F.lit(0).alias("d"), F.lit("").alias("s"))

    def step(a: Column, x: Column) -> Column:
        d = a["d"]
        mark = (F.when((x == ",") & (d == 0), F.lit(CLAUSE)).when((x == ",") & (d == 1), F.lit(ITEM))
                .when((x == "(") & (d == 0), F.lit(OPEN)).when((x == ")") & (d == 1), F.lit(CLOSE)).otherwise(x))
        depth = d + F.when(x == "(", 1).when(x == ")", -1).otherwise(0)
        return F.struct(depth.alias("d"), F.concat_ws(" ", F.nullif(a["s"], F.lit("")), mark).alias("s"))

    def of_tokens(t: Column) -> Column:
        return F.when(F.array_join(F.slice(t, 1, 8), " ").rlike(STATEMENT.replace(_TABLE, "")), F.aggregate(t, start, step)["s"]).otherwise(F.lit(""))

    # a cheap look at the raw text spares other statements (long INSERTs) the tokens
    return F.when(q.rlike(r"(?i)\b(?:ALTER|CREATE|DROP|TRUNCATE|RENAME)\b"),
                  let(tokens(q), of_tokens)).otherwise(F.lit(""))


def plain(text: Column) -> Column:
    """Marks back to the punctuation they stand for."""
    return F.trim(F.translate(text, CLAUSE + ITEM + OPEN + CLOSE, ",,()"))


def name_text(name: Column) -> Column:
    """A name as the user wrote it, without quotes."""
    return F.when(name.startswith("`"), F.decode(F.unhex(F.translate(name, "`", "")), "UTF-8")).otherwise(name)


def type_text(kind: Column) -> Column:
    """A column type as a catalogue writes it: lower case, no spaces in brackets, labels quoted."""
    t = F.regexp_replace(F.lower(kind), r" ?([(),]) ?", "$1")
    t = F.regexp_replace(t, r"\)(?=\w)", ") ")
    parts = F.transform(F.split(t, "'"), lambda x, i: F.when(
        i % 2 == 1, F.concat(F.lit("'"), F.replace(F.decode(F.unhex(x), "UTF-8"), F.lit("'"), F.lit("''")), F.lit("'"))).otherwise(x))
    return F.array_join(parts, "")


def _group(text: Column, pattern: str, g: int | None) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, g), F.lit("")) if g else F.lit(None).cast("string")


def _table(text: Column, pattern: str, g: int) -> Column:
    return F.struct(F.coalesce(name_text(_group(text, pattern, g)), F.lit("")).alias("sql_db"),
                    F.coalesce(name_text(_group(text, pattern, g + 1)), F.lit("")).alias("tbl"))


def target(mark: Column) -> Column:
    """(kind, db named in the SQL or '', table) of a marked statement; empty strings for others."""
    return let(plain(mark), lambda text: F.struct(F.upper(F.regexp_extract(text, STATEMENT, 1)).alias("kind"),
                                                   *[_table(text, STATEMENT, 2)[f].alias(f) for f in ("sql_db", "tbl")]))


def table_moves(mark: Column) -> Column:
    """What a marked statement does to tables: array of (action, sql_db, tbl, new_db, new_tbl), in order.

    Actions: ``create``, ``drop``, ``drop_if`` (IF EXISTS: no sign that the table is there), ``rename``, and
    ``change`` for statements that keep the table's name.
    """
    return let(mark, lambda m: let(plain(m), lambda text: _moves(m, text)))


def _moves(mark: Column, text: Column) -> Column:
    kind = F.upper(F.regexp_extract(text, STATEMENT, 1))
    none = F.struct(F.lit("").alias("sql_db"), F.lit("").alias("tbl"))

    def move(action: str | Column, t: Column, new: Column) -> Column:
        return F.struct((action if isinstance(action, Column) else F.lit(action)).alias("action"), t["sql_db"].alias("sql_db"), t["tbl"].alias("tbl"),
                        new["sql_db"].alias("new_db"), new["tbl"].alias("new_tbl"))

    first = _table(text, STATEMENT, 2)
    head = rf"(?i)^\w+(?: \w+)*? TABLES?(?: IF EXISTS)? (?={_N})"
    listed = F.split(F.regexp_replace(F.regexp_replace(mark, head, ""), r"(?i)(?: (?:RESTRICT|CASCADE))?(?: ;)?\s*$", ""), CLAUSE)
    listed = F.transform(listed, lambda x: plain(x))
    pair = rf"(?i)^{_TABLE}(?: (?:WAIT \d+|NOWAIT))? TO {_TABLE}$"
    renamed = rf"(?i)^RENAME(?: TO| AS| =)? (?!COLUMN |INDEX |KEY ){_TABLE}(?: ;)?$"
    moved = let(F.get(F.filter(clauses(mark), lambda x: x.rlike(renamed)), F.lit(0)), lambda c: F.when(
        c.isNotNull(), move("rename", first, _table(c, renamed, 1))).otherwise(move("change", first, none)))
    out = (F.when(kind == "DROP", F.transform(listed, lambda x: move(F.when(text.rlike("(?i) IF EXISTS "), "drop_if").otherwise("drop"), _table(x, rf"^{_TABLE}", 1), none)))
           .when(kind == "RENAME", F.transform(F.filter(listed, lambda x: x.rlike(pair)), lambda x: move("rename", _table(x, pair, 1), _table(x, pair, 3))))
           .when(kind == "CREATE", F.array(move("create", first, none)))
           .when(kind.isin("ALTER", "TRUNCATE"), F.array(moved)))
    return F.coalesce(out, F.filter(F.array(move("", none, none)), lambda x: F.lit(False)))


def clauses(mark: Column) -> Column:
    """The clauses of a marked ALTER TABLE or CREATE TABLE, canonical and in order.

    The elements of a CREATE's list and of ``ADD (a INT, b INT)`` come as ``ADD`` clauses of their own.
    """
    return let(mark, lambda m: let(F.regexp_replace(m, STATEMENT, ""), lambda body: _clauses(m, body)))


def _clauses(mark: Column, body: Column) -> Column:
    parts = F.transform(F.split(body, CLAUSE), lambda c: F.trim(c))
    listed = rf"(?i)^ADD (?:COLUMN )?{OPEN}([^{OPEN}{CLOSE}]*){CLOSE}(?: ;)?$"

    def items(x: Column) -> Column:
        return F.transform(F.split(x, ITEM), lambda i: F.concat(F.lit("ADD "), plain(i)))

    alter = F.flatten(F.transform(parts, lambda c: F.when(c.rlike(listed), items(F.regexp_extract(c, listed, 1)))
                                  .otherwise(F.array(F.regexp_replace(plain(c), r" ;$", "")))))
    made = rf"{OPEN}([^{OPEN}{CLOSE}]*){CLOSE}"
    create = F.when(body.rlike(rf"^\s*{made}"), items(F.regexp_extract(body, made, 1))).otherwise(F.array().cast("array<string>"))
    return F.when(mark.rlike(r"(?i)^ALTER "), alter).when(mark.rlike(r"(?i)^CREATE "), create).otherwise(F.array().cast("array<string>"))


def actions(mark: Column) -> Column:
    """What a marked statement does to columns and keys, in order: array of ``ACTION`` structs.

    ``place`` is ``first``, ``after`` (then ``anchor`` names the column) or null.  A column clause that
    makes the column a key gives a second action.  Other clauses give none.
    """
    def build(action: str | Column, **parts: Column) -> Column:
        empty = {"column": "string", "new_name": "string", "type": "string", "place": "string", "anchor": "string",
                 "key_name": "string", "key_kind": "string", "key_columns": "array<string>"}
        return F.struct(F.lit(action).alias("action"), *[parts.get(k, F.lit(None).cast(t)).alias(k) for k, t in empty.items()])

    def names(listed: Column) -> Column:
        return F.transform(F.split(listed, " , "), lambda x: name_text(F.regexp_extract(x, rf"^({_N})", 1)))

    place = rf"(?i) (FIRST|AFTER)(?: ({_N}))?$"

    def of_clause(c: Column) -> Column:
        column = F.lit(None).cast(ACTION)
        for action, pattern, name, new, kind in reversed(COLUMN_CLAUSES):
            where = {} if kind is None else {"place": F.lower(_group(c, place, 1)), "anchor": name_text(_group(c, place, 2))}
            column = F.when(c.rlike(pattern), build(action, column=name_text(_group(c, pattern, name)), new_name=name_text(_group(c, pattern, new)),
                                                    type=type_text(_group(c, pattern, kind)), **where)).otherwise(column)
        key = F.lit(None).cast(ACTION)
        for action, kind, pattern, name, listed in reversed(KEY_CLAUSES):
            columns = names(_group(c, pattern, listed)) if listed else F.lit(None).cast("array<string>")
            called = F.lit(PRIMARY) if kind == "PRI" else F.coalesce(name_text(_group(c, pattern, name)), F.get(columns, F.lit(0)))
            key = F.when(c.rlike(pattern), build(action, key_name=called, key_kind=F.lit(kind), key_columns=columns)).otherwise(key)
        return let(column, lambda x: F.array_compact(F.array(x, key, inline(c, x))))

    def inline(c: Column, column: Column) -> Column:
        """The key that a column clause makes of its column."""
        own = F.coalesce(column["new_name"], column["column"])
        kind = (F.when(c.rlike(r"(?i) PRIMARY KEY\b"), "PRI").when(c.rlike(r"(?i) UNIQUE\b"), "UNI")
                 .when(c.rlike(r"(?i) KEY\b") & ~c.rlike(r"(?i) REFERENCES\b"), "PRI"))
        return F.when(column["action"].isin("add", "modify", "change") & kind.isNotNull(),
                      build("add_key", key_name=F.when(kind == "PRI", PRIMARY).otherwise(own), key_kind=kind, key_columns=F.array(own)))

    return F.flatten(F.transform(clauses(mark), of_clause))
