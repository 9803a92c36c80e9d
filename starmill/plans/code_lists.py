"""Fixed values of the public-health warehouse: code lists and the region of each state.

Code and label must equal the published ones for right results; keys are positions.
"""

from __future__ import annotations

CIRCUMSTANCES = [
    (1, "Acidente"),
    (2, "Suicídio"),
    (3, "Homicídio"),
    (4, "Outros"),
]

SCHOOLING = [
    (0, "Sem Escolaridade"),
    (1, "Fundamental I Incompleto"),
    (2, "Fundamental I Completo"),
    (3, "Fundamental II Incompleto"),
    (4, "Fundamental II Completo"),
    (5, "Ensino Médio Incompleto"),
    (6, "Ensino Médio Completo"),
    (7, "Superior Incompleto"),
    (8, "Superior Completo"),
    (9, "Ignorado"),
    (10, "Fundamental I Incompleto ou Inespecífico"),
    (11, "Fundamental II Incompleto ou Inespecífico"),
    (12, "Ensino Médio Incompleto ou Inespecífico"),
]

MARITAL_STATUS = [
    (1, "Solteiro"),
    (2, "Casado"),
    (3, "Viúvo"),
    (4, "Separado Judicialmente"),
    (5, "União Estável"),
]

RACES = [
    (1, "Branca"),
    (2, "Preta"),
    (3, "Amarela"),
    (4, "Parda"),
    (5, "Indígena"),
]

SEXES = [
    ("0", "Ignorado"),
    ("1", "Masculino"),
    ("2", "Feminino"),
    ("9", "Ignorado"),
    ("M", "Masculino"),
    ("F", "Feminino"),
    ("I", "Ignorado"),
]

PLACE_TYPES = [
    (1, "Via Pública"),
    (2, "Endereço Residência"),
    (3, "Outro Domicílio"),
    (4, "Estabelecimento Comercial"),
    (5, "Outros"),
    (9, "Ignorado"),
]

REGIONS = [
    ("Norte",),
    ("Nordeste",),
    ("Centro-Oeste",),
    ("Sudeste",),
    ("Sul",),
]

# In the order of the official state codes.
REGION_OF_STATE = {
    "Rondônia": "Norte",
    "Acre": "Norte",
    "Amazonas": "Norte",
    "Roraima": "Norte",
    "Pará": "Norte",
    "Amapá": "Norte",
    "Tocantins": "Norte",
    "Maranhão": "Nordeste",
    "Piauí": "Nordeste",
    "Ceará": "Nordeste",
    "Rio Grande do Norte": "Nordeste",
    "Paraíba": "Nordeste",
    "Pernambuco": "Nordeste",
    "Alagoas": "Nordeste",
    "Sergipe": "Nordeste",
    "Bahia": "Nordeste",
    "Minas Gerais": "Sudeste",
    "Espírito Santo": "Sudeste",
    "Rio de Janeiro": "Sudeste",
    "São Paulo": "Sudeste",
    "Paraná": "Sul",
    "Santa Catarina": "Sul",
    "Rio Grande do Sul": "Sul",
    "Mato Grosso do Sul": "Centro-Oeste",
    "Mato Grosso": "Centro-Oeste",
    "Goiás": "Centro-Oeste",
    "Distrito Federal": "Centro-Oeste",
}
