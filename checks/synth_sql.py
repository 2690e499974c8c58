"""SQL text for generated reports, built from the phrase book alone."""

from __future__ import annotations

from claimwise.phrases import DEFAULT_BOOK, NUMBERS, PhraseBook

#: The known case types.
CASES = ["Front Collision", "Parked Car", "Rear Collision", "Side Collision", "Vehicle Theft"]


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listing(values: list[str]) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def case_sql(candidates: list[str]) -> str:
    known = ", ".join(text(c) for c in CASES)
    tries = ", ".join(f"CASE WHEN trim({c}) IN ({known}) THEN trim({c}) END" for c in candidates)
    return f"coalesce({tries}, 'Side Collision')"


def report_sql(source: str, key: str, seed: int, keep: list[str], candidates: list[str], combined: bool = True,
               book: PhraseBook = DEFAULT_BOOK, name: str = "generated_description") -> str:
    most = max(high for _, high in book.harm.values())
    labels = ["plan", "count", *[f"item {i}" for i in range(most)], *book.parts, *[f"number {p}" for p in NUMBERS if p in book.parts]]
    words = range((len(labels) + 6) // 7)

    def draw(label: str) -> str:
        i = labels.index(label)
        return f"((w{i // 7} >> {8 * (i % 7)}) & 255)"

    def by_scene(value) -> str:
        return "CASE " + " ".join(f"WHEN kind = {text(c)} AND level = '{level}' THEN {value(c, level)}"
                                  for c in CASES for level in ("major", "minor")) + " END"

    if combined:
        vehicle = "split_part(auto_make_model, ' ', 1) || ' ' || trim(substr(auto_make_model, length(split_part(auto_make_model, ' ', 1)) + 2))"
    else:
        vehicle = "trim(auto_make) || ' ' || trim(auto_model)"
    vehicle += " || coalesce(' (' || nullif(CAST(auto_year AS STRING), '') || ')', '')"
    numbers = ", ".join(f"('0x' || substr(md5(CAST({key} AS STRING) || '|{seed}|{i // 2}'), {16 * (i % 2) + 1}, 15))::BIGINT AS w{i}" for i in words)
    steps = [
        f"s0 AS (SELECT *, {vehicle} AS vehicle, {case_sql(candidates)} AS kind, "
        f"CASE WHEN incident_severity IN ('Major Damage', 'Total Loss') THEN 'major' ELSE 'minor' END AS level, {numbers} FROM {source} src)"]
    clauses = []
    for part in book.parts:
        if part == "harm":
            continue
        pick = by_scene(lambda c, s, part=part: f"({listing(book.pool(part, c, s))})[1 + {draw(part)} % {len(book.pool(part, c, s))}]")
        least, step, count = NUMBERS.get(part, (0, 0, 1))
        value = f"CAST({draw(f'number {part}')} % {count} * {step} + {least} AS STRING)" if part in NUMBERS else "vehicle"
        clauses.append(f"replace({pick}, '{{}}', {value}) AS c_{part}")
    pool = by_scene(lambda c, s: listing(book.pool("harm", c, s)))
    ranges = by_scene(lambda c, s: f"{book.harm_range(c, s)[0]} + {draw('count')} % {book.harm_range(c, s)[1] - book.harm_range(c, s)[0] + 1}")
    steps.append(f"q0 AS (SELECT *, {', '.join(clauses)}, {ranges} AS k, {pool} AS pool0 FROM s0)")
    for i in range(most):
        steps.append(f"p{i} AS (SELECT *, pool{i}[1 + {draw(f'item {i}')} % greatest(len(pool{i}), 1)] AS h{i} FROM q{i})")
        steps.append(f"q{i + 1} AS (SELECT *, list_filter(pool{i}, lambda x: x <> h{i}) AS pool{i + 1} FROM p{i})")
    steps.append(f"d AS (SELECT *, array_to_string([{', '.join(f'h{i}' for i in range(most))}][1:k], ', ') || '.' AS c_harm FROM q{most})")
    def planned(c: str, s: str) -> str:
        plans = book.plans_of(c, s)
        return f"CASE {draw('plan')} % {len(plans)} " + " ".join(
            f"WHEN {i} THEN concat_ws(' ', {', '.join(f'c_{p}' for p in plan)})" for i, plan in enumerate(plans)) + " END"

    final = f"trim(regexp_replace({by_scene(planned)}, '\\s+', ' ', 'g'))"
    return f"WITH {', '.join(steps)} SELECT {', '.join(keep)}, {final} AS {name} FROM d"
