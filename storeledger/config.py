"""Business rules: every constant a job depends on, overridable per deployment."""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal


@dataclass(frozen=True)
class Rules:
    # Statuses, labels, bounds and list sizes of the retail rule book.
    statuses: tuple[str, ...] = ("payée", "expédiée", "livrée", "annulée")
    excluded_statuses: tuple[str, ...] = ("annulée",)
    price_threshold: Decimal = Decimal("100")
    city: str = "Paris"
    basket_bounds: tuple[Decimal, Decimal] = (Decimal("500"), Decimal("1500"))
    basket_labels: tuple[str, str, str] = ("Petit panier", "Panier moyen", "Gros panier")
    basket_unknown_label: str = "Non calculable"
    semester_labels: tuple[str, str] = ("1er semestre", "2e semestre")
    sales_months: int = 12
    cover_bounds: tuple[int, int] = (1, 3)
    risk_labels: tuple[str, str, str] = ("Risque élevé", "À surveiller", "Stock suffisant")
    big_basket: Decimal = Decimal("1500")
    active_months: int = 12
    top_products: int = 10
    top_customers: int = 10
    top_months: int = 6
    tightest_stocks: int = 15

    # Presentation: a global sort costs one more shuffle, so a job that feeds a table rather than a reader
    # turns it off. Top-k results keep their order either way.
    ordered: bool = True
    # ICU collation of the sorted text columns (accented letters next to their base letter); None sorts by bytes.
    text_collation: str | None = "UNICODE"

    def unordered(self) -> Rules:
        """The same rules for an intermediate result, which nobody reads in order."""
        return replace(self, ordered=False)
