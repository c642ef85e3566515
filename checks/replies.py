"""Made answers of a text model, as templates: @n is a number, @s a status."""

from __future__ import annotations

from statuslight.operators import details, reporting

TIMELINE_ARRAY = (
    '[{"event_date": "2001-01-2@n", "event_description": "second @n"}, {"event_description": "undated"}, '
    '{"event_date": "2001-01-05", "event_description": "first"}, {"event_date": {"day": 1}, "event_description": 7}]'
)
TIMELINE_STRING = '"' + TIMELINE_ARRAY.replace('"', '\\"') + '"'

_FIELDS = [
    f'"{key}": "{"@s" if key.endswith("_status") else "reason @n" if key == "overall_rationale" else key + " of @n"}"'
    for key in reporting.STATUS_FIELDS
]
STATUS_TEMPLATE = (
    "```json\n{\n" + ",\n".join(_FIELDS) + f',\n"{reporting.TIMELINE}": {TIMELINE_ARRAY}' + "\n}\n```"
)

# what turns an answer into one that repeats a key at the top, with a text that begins with a bracket, or within an event
TWICE = ('"scope_status":', '"scope_status": "first", "scope_status":')
BRACKET = ('"reason ', '"[late] reason ')
EVENT_TWICE = ('"event_description": "first"', '"event_description": "first", "event_description": "[second]"')

DETAIL_TEMPLATES = {
    "objectives": (
        '```json\n[{"objective_number": 1, "objective_details": "faster @n", "expected_benefit": "less\\nwork", "objective_metric": "days"}, '
        '{"objective_number": "2", "objective_details": {"nested": true}}]\n```'
    ),
    "summary": '```json\n{"Background": "b@n", "Requirements": ["r"], "Solution": 1.5, "Assumptions": null}\n```',
    "deliverables": '```json\n[{"deliverable_number": "@n", "deliverable_details": "plan", "deliverable_format": null, "acceptance_criteria": "signed"}]\n```',
}

JSON_SAMPLE = (
    '{"a": 1.50, "b": {"x": 1}, "c": [1, "two", {"three": 3}, null, [4]], "d": null, "e": "text \\"@n\\" é", '
    '"f": true, "g": @n, "h": "{\\"looks\\": \\"nested\\"}"}'
)


def status_reply(number: int) -> str:
    return STATUS_TEMPLATE.replace("@n", str(number)).replace("@s", ["RED", "AMBER", "GREEN"][number % 3])


# what the counting model counts in a prompt
MARKS = ['"task_status":"In Progress"', '"CONCERNED"', '"document":']


def counting_backend():
    """A local text model that looks at the prompt's evidence: open tasks, worried comments and documents."""
    return lambda prompts, options: [status_reply(sum(p.count(mark) for mark in MARKS)) for p in prompts]


def no_backend():
    raise AssertionError("every prompt has an answer")


VOWELS = "aeiou"


def vowel_backend():
    """A local embedding model: how often each vowel occurs."""
    return lambda contents: [[float(c.count(v)) for v in VOWELS] for c in contents]


def details_backend():
    """A local text model for the three questions: its number is how often e occurs in the prompt."""
    kinds = {text[:20]: kind for kind, text in details.INSTRUCTIONS.items()}
    return lambda prompts, options: [DETAIL_TEMPLATES[kinds[p[:20]]].replace("@n", str(p.count("e"))) for p in prompts]
