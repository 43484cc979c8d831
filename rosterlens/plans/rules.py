"""Declarative rules: element predicates, reference checks, score weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import has_key


@dataclass(frozen=True)
class Element:
    """An element of a resource: present if its JSON key is, or if the named columns aren't null."""

    name: str
    required: bool = False
    columns: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return self.name

    def condition(self) -> Column:
        if not self.columns:
            return has_key(F.col("resource"), self.key)
        out = F.lit(True)
        for c in self.columns:
            out = out & F.col(c).isNotNull()
        return out


REQUIRED = True

# Elements by table, which of them are required, and the columns of those that no JSON key stands for.
ELEMENTS: dict[str, tuple[Element, ...]] = {
    "organization": (Element("active", REQUIRED), Element("name", REQUIRED), Element("identifier"), Element("type"), Element("telecom"), Element("address")),
    "practitioner": (Element("name", REQUIRED), Element("identifier_npi", columns=("npi",)), Element("active"), Element("qualification"), Element("telecom")),
    "practitioner_role": (Element("practitioner"), Element("organization"), Element("code"), Element("specialty"), Element("location")),
    "location": (
        Element("status"), Element("name", REQUIRED), Element("type"), Element("telecom"), Element("address"),
        Element("position_geo", columns=("latitude", "longitude")), Element("managingOrganization"),
    ),
    "healthcare_service": (Element("providedBy"), Element("location"), Element("type"), Element("specialty"), Element("name")),
    "organization_affiliation": (Element("active"), Element("organization"), Element("participatingOrganization"), Element("network"), Element("code"), Element("location")),
    "insurance_plan": (Element("identifier"), Element("type"), Element("name", REQUIRED), Element("ownedBy"), Element("administeredBy"), Element("coverageArea"), Element("plan")),
    "endpoint_resource": (Element("status", REQUIRED), Element("connectionType", REQUIRED), Element("address", REQUIRED), Element("payloadType")),
}


@dataclass(frozen=True)
class Check:
    """A reference column, the table it points to, whether it is an array, and the name it is reported under."""

    source: str
    column: str
    many: bool
    target: str
    label: str


# The reference columns, their targets and labels.
CHECKS = (
    Check("practitioner_role", "practitioner_ref", False, "practitioner", "PractitionerRole.practitioner"),
    Check("practitioner_role", "organization_ref", False, "organization", "PractitionerRole.organization"),
    Check("practitioner_role", "location_refs", True, "location", "PractitionerRole.location"),
    Check("practitioner_role", "healthcare_service_refs", True, "healthcare_service", "PractitionerRole.healthcareService"),
    Check("practitioner_role", "network_refs", True, "organization", "PractitionerRole.network"),
    Check("organization_affiliation", "organization_ref", False, "organization", "OrganizationAffiliation.organization"),
    Check("organization_affiliation", "participating_organization_ref", False, "organization", "OrganizationAffiliation.participatingOrganization"),
    Check("organization_affiliation", "network_refs", True, "organization", "OrganizationAffiliation.network"),
    Check("organization_affiliation", "location_refs", True, "location", "OrganizationAffiliation.location"),
    Check("organization_affiliation", "healthcare_service_refs", True, "healthcare_service", "OrganizationAffiliation.healthcareService"),
    Check("location", "managing_organization_ref", False, "organization", "Location.managingOrganization"),
    Check("healthcare_service", "provided_by_ref", False, "organization", "HealthcareService.providedBy"),
    Check("healthcare_service", "location_refs", True, "location", "HealthcareService.location"),
    Check("insurance_plan", "owned_by_ref", False, "organization", "InsurancePlan.ownedBy"),
    Check("insurance_plan", "administered_by_ref", False, "organization", "InsurancePlan.administeredBy"),
    Check("insurance_plan", "coverage_area_refs", True, "location", "InsurancePlan.coverageArea"),
    Check("insurance_plan", "network_refs", True, "organization", "InsurancePlan.network"),
    Check("organization", "part_of_ref", False, "organization", "Organization.partOf"),
)

DIMENSIONS = ("completeness", "conformance", "referential_integrity", "freshness", "uniqueness", "consistency")

# Weights of the dimensions by scheme.
SCHEMES = {
    "default": (0.20, 0.20, 0.20, 0.15, 0.10, 0.15),
    "equal": (1 / 6,) * 6,
    "conformance_focused": (0.20, 0.30, 0.25, 0.10, 0.05, 0.10),
}


def source_filter(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` has ``value``; an unknown column fails at analysis."""
    return df.filter(df[column] == value)
