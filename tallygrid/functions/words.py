"""Word lists and code tables that results depend on."""

# Words that mean "no value" in data columns.
NULL_WORDS = [
    "", "nan", "none", "null", "<na>", "#nulo#", "sem valor", "sem_valor",
    "nao informado", "nao informado.", "geral",
]

# Spellings of a missing value left behind by text conversion.
MISSING_SPELLINGS = ["", "nan", "none", "null", "<na>"]

# Words rejected in labels shown to people.
LABEL_NULL_WORDS = [
    "", "sem valor", "sem_valor", "nan", "none", "null", "<na>", "#nulo#", "geral",
    "nao informado", "não informado",
]

# Words that turn into the label "Sem valor".
CATEGORY_NULL_WORDS = [
    "", "nan", "none", "null", "<na>", "na", "n/a", "sem_valor", "nao informado",
    "não informado",
]

# Words that a locale-aware number parser treats as missing.
NUMBER_NULL_WORDS = ["", "nan", "none", "null", "na", "n/a"]

_UNKNOWN = {code: "Nao informado" for code in ("0", "-1", "-3", "-4")}

# Published code -> label tables, by role.
CATEGORY_LABELS = {
    "uf": {
        "AC": "Acre", "AL": "Alagoas", "AP": "Amapa", "AM": "Amazonas", "BA": "Bahia",
        "CE": "Ceara", "DF": "Distrito Federal", "ES": "Espirito Santo", "GO": "Goias",
        "MA": "Maranhao", "MT": "Mato Grosso", "MS": "Mato Grosso do Sul",
        "MG": "Minas Gerais", "PA": "Para", "PB": "Paraiba", "PR": "Parana",
        "PE": "Pernambuco", "PI": "Piaui", "RJ": "Rio de Janeiro",
        "RN": "Rio Grande do Norte", "RS": "Rio Grande do Sul", "RO": "Rondonia",
        "RR": "Roraima", "SC": "Santa Catarina", "SP": "Sao Paulo", "SE": "Sergipe",
        "TO": "Tocantins",
    },
    "perfil_genero": {
        "1": "Masculino", "2": "Masculino", "3": "Feminino", "4": "Feminino",
        "M": "Masculino", "F": "Feminino", "MASC": "Masculino", "FEM": "Feminino",
        **_UNKNOWN,
    },
    # Codes 1600..2000 are single years, XXYY codes are the five-year bands.
    "perfil_faixa_etaria": {
        "1600": "16 anos", "1700": "17 anos", "1800": "18 anos", "1900": "19 anos", "2000": "20 anos",
        "2124": "21 a 24 anos", "2529": "25 a 29 anos", "3034": "30 a 34 anos", "3539": "35 a 39 anos",
        "4044": "40 a 44 anos", "4549": "45 a 49 anos", "5054": "50 a 54 anos", "5559": "55 a 59 anos",
        "6064": "60 a 64 anos", "6569": "65 a 69 anos", "7074": "70 a 74 anos", "7579": "75 a 79 anos",
        "8084": "80 a 84 anos", "8589": "85 a 89 anos", "9094": "90 a 94 anos", "9599": "95 a 99 anos",
        "9999": "100 anos ou mais",
        **_UNKNOWN,
    },
    "turno": {"1": "Primeiro turno", "2": "Segundo turno", "0": "Turno nao informado"},
    "cargo": {
        "1": "Presidente", "3": "Governador", "5": "Senador", "6": "Deputado federal",
        "7": "Deputado estadual", "8": "Deputado distrital", "9": "Deputado estadual",
        "11": "Prefeito", "12": "Vice-prefeito", "13": "Vereador",
    },
    "perfil_instrucao": {
        "1": "Analfabeto", "2": "Le e escreve", "3": "Fundamental incompleto",
        "4": "Fundamental completo", "5": "Medio incompleto", "6": "Medio completo",
        "7": "Superior incompleto", "8": "Superior completo", **_UNKNOWN,
    },
    "perfil_estado_civil": {
        "1": "Solteiro", "3": "Casado", "5": "Viuvo", "7": "Separado judicialmente",
        "9": "Divorciado", **_UNKNOWN,
    },
    "perfil_raca_cor": {
        "1": "Branca", "2": "Preta", "3": "Parda", "4": "Amarela", "5": "Indigena",
        "6": "Nao informado", **_UNKNOWN,
    },
    "perfil_biometria": {
        "S": "Com biometria", "SIM": "Com biometria", "1": "Com biometria",
        "N": "Sem biometria", "NAO": "Sem biometria", "0": "Sem biometria",
        "-1": "Nao informado", "-3": "Nao informado", "-4": "Nao informado",
    },
}

# Readable names of dimension columns.
FIELD_LABELS = {
    "ano": "Ano", "uf": "UF", "regiao": "Regiao", "cargo": "Cargo", "turno": "Turno",
    "partido": "Partido", "candidato": "Candidato",
    "perfil_faixa_etaria": "Faixa etaria", "perfil_genero": "Genero",
    "perfil_instrucao": "Instrucao", "perfil_estado_civil": "Estado civil",
    "perfil_raca_cor": "Raca/cor", "perfil_biometria": "Biometria",
    "perfil_predominante_setor": "Perfil predominante",
    "partido_vencedor_setor": "Partido vencedor",
    "candidato_vencedor_setor": "Candidato vencedor", "vencedor_setor": "Vencedor",
    "faixa_votos_setor": "Faixa de votos",
    "faixa_abstencao_setor": "Faixa de abstencao",
    "faixa_comparecimento_setor": "Faixa de comparecimento",
    "municipio_grupo": "Municipio",
}

# The five regions and their states.
REGION_STATES = {
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}

# Raw column names accepted for each profile dimension, best first.
PROFILE_ALIASES = {
    "perfil_faixa_etaria": [
        "perfil_faixa_etaria", "faixa_etaria", "ds_faixa_etaria", "cd_faixa_etaria",
        "idade", "nr_idade_data_posse",
    ],
    "perfil_genero": [
        "perfil_genero", "sexo_genero", "genero", "sexo", "ds_genero", "cd_genero",
        "ds_sexo", "cd_sexo",
    ],
    "perfil_instrucao": [
        "perfil_instrucao", "perfil_escolaridade", "escolaridade", "instrucao",
        "grau_instrucao", "grau_escolaridade", "ds_grau_instrucao", "cd_grau_instrucao",
        "nr_grau_instrucao", "tp_grau_instrucao", "ds_grau_escolaridade",
        "cd_grau_escolaridade", "nr_grau_escolaridade", "tp_grau_escolaridade",
        "ds_instrucao", "cd_instrucao", "ds_escolaridade", "cd_escolaridade",
        "candidato_instrucao", "candidato_escolaridade",
    ],
    "perfil_estado_civil": [
        "perfil_estado_civil", "estado_civil", "ds_estado_civil", "cd_estado_civil",
        "tp_estado_civil",
    ],
    "perfil_raca_cor": [
        "perfil_raca_cor", "raca_cor", "raca", "cor", "ds_cor_raca", "cd_cor_raca",
        "ds_raca_cor", "cd_raca_cor",
    ],
}

# Accented letters and their plain forms.
ACCENTED = "ÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑáàâãäåéèêëíìîïóòôõöúùûüçñ"
UNACCENTED = "AAAAAAEEEEIIIIOOOOOUUUUCNaaaaaaeeeeiiiiooooouuuucn"
