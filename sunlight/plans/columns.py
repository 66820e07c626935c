"""Column names of the raw inputs. Builders take these as parameters so the
same code runs on the original exports and on any renamed copy."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DeclarationColumns:
    """Raw payment-declaration export (one row per declared payment)."""
    company: str = "raison_sociale"
    name: str = "identite"
    first_name: str = "prenom"
    profession: str = "profession_libelle"
    city: str = "ville"
    amount: str = "montant"
    date: str = "date"
    motive: str = "motif_lien_interet"
    postal_code: str = "code_postal"


@dataclass(frozen=True)
class PrescriptionColumns:
    """Reimbursed-prescription files (lower-cased names after loading)."""
    region: str = "ben_reg"
    speciality: str = "psp_spe"
    pack: str = "cip13"
    product: str = "l_cip13"
    generic_flag: str = "top_gen"
    boxes: str = "boites"
    reimbursed: str = "rem"
    prescriber: str = "pfs_exe_num"


RAW = DeclarationColumns()
RX = PrescriptionColumns()
