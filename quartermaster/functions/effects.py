"""Effect arrays: annotate (I6), append by name (I7), reclassify a record (I8)
and split by signed rules into buffs / debuffs (I9, I10).

An effect is ``struct<delay:int, value:double, type:string, skillName:string,
duration:int, chance:double, krSkill:string>``. Everything is a higher-order
array function (``transform`` / ``filter``), evaluated per row in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quartermaster.functions import vocab as V
from quartermaster.functions.labels import map_lit

EFFECT_DDL = ("struct<delay:int,value:double,type:string,skillName:string,"
              "duration:int,chance:double,krSkill:string>")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def effect(delay=None, value=None, type=None, skillName=None, duration=None,
           chance=None, krSkill=None) -> Column:
    """An effect struct literal in the canonical field order."""
    return F.struct(F.lit(delay).cast("int").alias("delay"),
                    F.lit(value).cast("double").alias("value"),
                    F.lit(type).cast("string").alias("type"),
                    F.lit(skillName).cast("string").alias("skillName"),
                    F.lit(duration).cast("int").alias("duration"),
                    F.lit(chance).cast("double").alias("chance"),
                    F.lit(krSkill).cast("string").alias("krSkill"))


def normalise_effects(c) -> Column:
    """A decoded effect array (read with the canonical effect struct) as the
    canonical array type; NULL arrays stay NULL."""
    return _c(c).cast(f"array<{EFFECT_DDL}>")


def annotate(c, skill_kr: dict, type_kr: dict) -> Column:
    """``krSkill`` = the skill label when the type is ``Skill`` and the
    skill is known, else the type label; NULL when neither is known
    (:func:`effects_json` then leaves the field out)."""
    sk, ty = map_lit(skill_kr), map_lit(type_kr)

    def one(e):
        lbl = F.coalesce(F.when(e["type"] == "Skill", F.try_element_at(sk, e["skillName"])),
                         F.try_element_at(ty, e["type"]))
        return e.withField("krSkill", F.coalesce(lbl, e["krSkill"]))
    return F.transform(_c(c), one)


def append_by_name(c, name, table: dict[str, Column]) -> Column:
    """Append the effect registered for ``name`` (if any) to the array.
    A NULL array stays NULL."""
    n = _c(name)
    expr = None
    for k, eff in table.items():
        cond = n == F.lit(k)
        val = F.array_append(_c(c), eff)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return _c(c) if expr is None else expr.otherwise(_c(c))


def injector_painkillers() -> dict[str, Column]:
    return {n: effect(delay=0, value=0.0, type="painkillerDuration", duration=d, chance=1.0)
            for n, d in V.INJECTOR_PAINKILLER}


def drink_painkillers() -> dict[str, Column]:
    return {n: effect(delay=1, value=1.0, type="Skill", skillName="Painkiller", duration=d,
                      krSkill=V.DRINK_PAINKILLER_KR)
            for n, d in V.DRINK_PAINKILLER}


def reclassified_effects() -> Column:
    """I8: the constant effect list of the reclassified product."""
    return F.array(*[effect(delay=0, value=v, type=t, duration=d, chance=1.0)
                     for d, t, v in V.RECLASSIFIED_EFFECTS])


# ------------------------------------------------------------ buff / debuff

#: Rule table of I9 / I10: (type or None for any listed skill, field, sign).
#: sign 0 = always; +1 = field > 0; -1 = field < 0.
def _rules(side: str):
    pos, neg = (1, -1) if side == "buff" else (-1, 1)
    rules = [(t, None, 0) for t in (V.ALWAYS_BUFF if side == "buff" else V.ALWAYS_DEBUFF)]
    rules.append((V.INVERTED_TYPE, "value", neg))
    rules += [(t, "value", pos) for t in V.SIGNED_TYPES]
    rules.append((V.DURATION_TYPE, "duration", pos))
    rules.append(("Skill", "value", pos))
    return rules


def effect_rule(e: Column, side: str) -> Column:
    """Predicate of one effect for ``side`` in {"buff", "debuff"}. Value 0,
    unknown types and skills outside the listed twelve match neither."""
    cond = F.lit(False)
    for t, field, sign in _rules(side):
        c = e["type"] == F.lit(t)
        if t == "Skill":
            c = c & e["skillName"].isin(*V.SIGNED_SKILLS)
        if sign > 0:
            c = c & (e[field] > 0)
        elif sign < 0:
            c = c & (e[field] < 0)
        cond = cond | c
    return F.coalesce(cond, F.lit(False))


def split_effects(c, side: str) -> Column:
    """The effects that are buffs (or debuffs), in order."""
    return F.filter(_c(c), lambda e: effect_rule(e, side))


def effects_json(c, chance: bool = True) -> Column:
    """X11 for an effect array: the fields of its selection, null ones kept
    (food and drink effects have no ``chance``), and ``krSkill`` only where
    there is a label. A NULL array stays NULL."""
    fields = ["delay", "value", "type", "skillName", "duration", *(["chance"] if chance else [])]

    def one(e):
        plain = [e[f].alias(f) for f in fields]
        keep = {"ignoreNullFields": "false"}
        return F.when(e["krSkill"].isNull(), F.to_json(F.struct(*plain), keep)) \
            .otherwise(F.to_json(F.struct(*plain, e["krSkill"].alias("krSkill")), keep))
    arr = _c(c)
    return F.when(arr.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(arr, one), ","), F.lit("]")))


def reclassify(cond: Column, overrides: dict[str, Column], cols: dict[str, Column]) -> list[Column]:
    """I8: for records matching ``cond``, the columns in ``overrides`` take
    the override (a literal, a NULL for removed fields); the others keep
    their value. Returns the projected columns in ``cols`` order."""
    return [F.when(cond, overrides[n]).otherwise(c).alias(n) if n in overrides else c.alias(n)
            for n, c in cols.items()]
