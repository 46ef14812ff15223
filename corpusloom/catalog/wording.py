"""Wording of the registered queries that make deterministic texts; a caller of the library brings their own."""

from __future__ import annotations

from corpusloom.functions.render import Wording

CLUB = Wording(
    levels={
        "vague": ["{app}: one {product}, nothing fancy."],
        "medium": ["Our club runs {app} and would enjoy a {product}.", "Members favour {style} tones.", "Half of them read it on the tram."],
        "complex": [
            "Our club runs {app} and would enjoy a {product}.", "Members favour {style} tones.", "Half of them read it on the tram.",
            "Please plan for this as well:\n- a guest who never signs up\n- a winter without network\n- next year's board taking over",
        ],
    }
)
CLUB_BASELINE = Wording(levels={"medium": ["{app} deserves a {product}."]})

LETTER = Wording(
    levels={
        "vague": ["<hail#1>, could you put together a {product} for {app}?", "Why now: <cause#2>.", "Paint it {style}.", "As for the rest, <wish#3>.", "<sign#4>."],
        "medium": [
            "A {product} for {app}, please, meant for [crowd#1].", "They dread [worry#2], so it should feel like [thing#3].",
            "We will use it <hour#4> in <place#5>.", "Paint it {style}.", "You have <budget#6>.", "<sign#7>.",
        ],
        "complex": [
            "<hail#1>, {app} needs a {product} that serves [crowd#2] and, on busy days, [crowd#3].", "All of them dread [worry#4] and [worry#5]; think of [thing#6].",
            "It lives in <place#7> and is used <hour#8>, even with <risk#9>.", "When something is saved, give <proof#10>.", "Paint it {style}.",
            "You have <budget#11>.", "<sign#12>.",
        ],
    },
    slots={
        "hail": ["Hello there", "Good morning", "Dear workshop"],
        "cause": ["our paper notebook fell apart", "the old spreadsheet crashed again", "the colleague who knew it all moved away"],
        "wish": ["surprise me", "borrow whatever idea you fancy"],
        "hour": ["at dawn", "between shifts", "late at night"],
        "place": ["a noisy bakery", "the back of a van", "a quiet archive"],
        "risk": ["gloves on", "a cracked screen", "the lights out"],
        "proof": ["a printed slip", "a short beep"],
        "budget": ["two afternoons", "one long weekend", "about a week"],
        "sign": ["Cheers, Ola", "Thanks in advance", "See you on Friday"],
    },
    lenses={
        "story": {"crowd": ["school classes", "grandparents"], "worry": ["losing the thread", "dry dates"], "thing": ["a ribbon of years", "a family tree"]},
        "search": {"crowd": ["warehouse pickers", "students before an exam"], "worry": ["forty near misses", "typing with one thumb"], "thing": ["a spyglass", "an index drawer"]},
        "planning": {"crowd": ["choir leaders", "night nurses"], "worry": ["double bookings", "forgotten birthdays"], "thing": ["a wall calendar", "a string of beads"]},
        "tracking": {"crowd": ["marathon beginners", "allergy patients"], "worry": ["gaps after holidays", "too many decimals"], "thing": ["a thermometer", "a tide chart"]},
        "making": {"crowd": ["puppet builders", "zine printers"], "worry": ["lost drafts", "smudged margins"], "thing": ["a workbench", "a light table"]},
        "buying": {"crowd": ["market stall owners", "gift hunters"], "worry": ["hidden fees", "parcels gone astray"], "thing": ["a till", "a shopping trolley"]},
        "general": {"crowd": ["passers-by", "lodgers"], "worry": ["small print", "dead ends"], "thing": ["a doorbell", "a noticeboard"]},
    },
)
