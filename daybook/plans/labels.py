"""Names that belong to a deployment rather than to the engine."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Labels:
    """The operator running the service and the service's product name.

    They occur in package names, in two geography field names and in report
    headers; data and headers of a deployment match only with the right ones, so neither has a default.
    """

    operator: str
    service: str

    @property
    def personal_packages(self) -> tuple[str, ...]:
        # Packages whose white-space pricing code gets the default code.
        return (
            "Chứng thư số cá nhân trên các ứng dụng",
            f"{self.service} cá nhân PS0 (Công dân)",
            f"{self.service} Personal App Sign Limit Std",
        )

    @property
    def district_field(self) -> str:
        return f"DistrictIdMy{self.operator}"

    @property
    def ward_field(self) -> str:
        return f"WardIdMy{self.operator}"

    @property
    def district_column(self) -> str:
        return f"district_id_my_{self.operator.lower()}"

    @property
    def ward_column(self) -> str:
        return f"ward_id_my_{self.operator.lower()}"
