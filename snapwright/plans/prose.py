"""The descriptive text of one snapshot row, assembled from optional sentences in a fixed order.

Fixed values: the sentence texts, their order and the default service name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapwright.functions.text import assemble, fragment, listing, sentence


def hours_sentence() -> Column:
    """Service hours before resource hours; "not known" asks the reader to call.

    A NULL ``hours_known`` decides nothing.
    """
    call = F.lit("Hours: Call to confirm hours.")
    return (
        F.when(~F.col("service_hours_known"), call)
        .when(F.col("service_hours_text").isNotNull(), sentence("Hours: ", F.col("service_hours_text")))
        .when(~F.col("resource_hours_known"), call)
        .when(F.col("resource_hours_text").isNotNull(), sentence("Hours: ", F.col("resource_hours_text")))
    )


def location_sentence() -> Column:
    """Present only with a street line; a missing city, state or postal code drops the whole piece."""
    return F.concat(
        F.lit("Location: "), "address_1", fragment(", ", F.col("address_2")), F.lit(", "), "city",
        F.lit(", "), "state_province", F.lit(" "), "postal_code", F.lit("."),
    )


def email_sentence() -> Column:
    return sentence("Email: ", F.coalesce("service_email", "resource_email"))


def website_sentence() -> Column:
    return F.coalesce(
        sentence("Service website: ", F.col("service_url")), sentence("Website: ", F.col("resource_website"))
    )


def program_sentence() -> Column:
    return F.concat(
        F.lit("Program: "), "program_name", fragment(" (", F.col("program_alternate_name"), ")"),
        fragment(". ", F.col("program_description")), F.lit("."),
    )


def prose_pieces() -> dict[str, Column]:
    """Piece name -> text or NULL, in the order they are joined."""
    c = F.col
    return {
        "organisation": F.concat(
            c("resource_name"), fragment(", also known as ", c("resource_alternate_name")), F.lit(".")
        ),
        "organisation_type": sentence("Organization type: ", c("legal_status")),
        "organisation_short": c("resource_short_description"),
        "organisation_long": c("resource_long_description"),
        "service": F.concat(
            F.lit("Service: "), F.coalesce(c("service_name"), F.lit("Unnamed Service")),
            fragment(" (also known as ", c("service_alternate_name"), ")"), F.lit("."),
        ),
        "service_short": c("service_short_description"),
        "service_long": c("service_long_description"),
        "program": program_sentence(),
        "categories": listing("Categories: ", c("category_names")),
        "eligibility": sentence("Eligibility: ", c("eligibility")),
        "eligibility_tags": listing("Who this service is for: ", c("eligibility_all")),
        "how_to_apply": sentence("How to apply: ", c("application_process"), ""),
        "required_documents": sentence("Required documents: ", c("required_documents")),
        "fee": sentence("Fee: ", c("fee")),
        "wait_time": sentence("Wait time: ", c("wait_time")),
        "interpretation": sentence("Interpretation services available: ", c("interpretation_services")),
        "hours": hours_sentence(),
        "location": location_sentence(),
        "phone": sentence("Phone: ", c("phone_text")),
        "email": email_sentence(),
        "website": website_sentence(),
        "instructions": sentence("Instructions: ", c("instructions_text")),
        "related_documents": sentence("Related documents: ", c("documents_text")),
    }


# Pieces that differ between the rows of one service; the others are joined once per service.
ROW_PIECES = ("hours", "location")


def service_prose() -> list[Column]:
    """The text before and after the row pieces, as columns ``prose_head`` and ``prose_tail``.

    The head always holds the service sentence; the tail is NULL when it has no piece.
    """
    pieces = prose_pieces()
    names = list(pieces)
    first, last = names.index(ROW_PIECES[0]), names.index(ROW_PIECES[-1])
    head = F.concat_ws(" ", *[pieces[name] for name in names[:first]])
    tail = F.nullif(F.concat_ws(" ", *[pieces[name] for name in names[last + 1 :]]), F.lit(""))
    return [head.alias("prose_head"), tail.alias("prose_tail")]


def row_prose() -> Column:
    return assemble(F.col("prose_head"), hours_sentence(), location_sentence(), F.col("prose_tail"))
