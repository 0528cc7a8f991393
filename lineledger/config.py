"""Every literal of the mart in one place, so that other data can use other values."""

from __future__ import annotations

from dataclasses import dataclass

# Ids, names and labels that readers of the mart rely on.
PARENTS_OF_SECTIONS = (2831576, 2831586, 42561, 42560, 2124383, 2743029, 2743027)
STANDALONE_SECTIONS = (2831542, 2831543, 59044, 2743041, 2831574, 2831602, 2831609, 2831612, 3081821)
FLAT_DEPARTMENTS = (2831576, 2831586, 2831572, 42561, 42560, 2124383, 2743029, 2743027)
PARTNER_ROOT = 59041
INVOICE_TYPE = "outbill"
REPRESENTATIVES = ("Представители Киров", "Представители Ижевск", "Рефералы")
GROUP_REPRESENTATIVES = "Представители"
GROUP_OFFICE = "Офис"
UNKNOWN = "Не известен"
UNKNOWN_SECTION = "Не известна"
CHANGED = "changed"
NOT_CHANGED = "not changed"
FOLDER_DEPTH = 4
FOLDER_NAME_LENGTH = 50


@dataclass(frozen=True)
class MartConfig:
    """Parameters of the sales mart.

    ``section_parent_ids``: departments whose children are sections.
    ``section_ids``: departments that are sections of their own.
    ``flat_ids``: departments that are department, section and sector at once.
    """

    section_parent_ids: tuple[int, ...] = PARENTS_OF_SECTIONS
    section_ids: tuple[int, ...] = STANDALONE_SECTIONS
    flat_ids: tuple[int, ...] = FLAT_DEPARTMENTS
    partner_root: int = PARTNER_ROOT
    invoice_type: str = INVOICE_TYPE
    representatives: tuple[str, ...] = REPRESENTATIVES
    folder_depth: int = FOLDER_DEPTH
    folder_name_length: int = FOLDER_NAME_LENGTH
