"""Questions across the star schema.

Every function takes ``t``, a mapping from table name to DataFrame (``star`` reads
the stored ones), and returns a DataFrame.  The composite questions come as a
single answer by parameters and, as ``…_all``, for all keys at once.
"""

from agrolume.plans.auditoria import auditoria_all, auditoria_estimativas
from agrolume.plans.base import star
from agrolume.plans.dossie import dossie_all, dossie_insumos
from agrolume.plans.janela import janela_all, janela_aplicacao
from agrolume.plans.listings import (
    get_cultura,
    get_municipio,
    list_agrofit,
    list_clima,
    list_conab,
    list_culturas,
    list_fertilizantes,
    list_municipios,
    list_pam,
    list_sigef,
    list_zarc,
    total_pages,
)
from agrolume.plans.raio_x import raio_x_all, raio_x_municipal
from agrolume.plans.viabilidade import viabilidade_all, viabilidade_economica

__all__ = [n for n in dir() if not n.startswith("_")]
