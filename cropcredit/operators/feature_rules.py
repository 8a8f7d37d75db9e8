"""Recode rules of the categorical features.

Everything between the FIXED VALUES markers is data that must equal the original
feature definitions for equal results: domain descriptions, their grouping into
classes, class names and rule order (first match wins). Lists are kept in their
original order. Column names refer to the domain table (DESCRICAO, FINALIDADE, ...)
or, for ``programa``, to the operation code itself.
"""

from __future__ import annotations

from cropcredit.operators.recode import Keep, Not, Recode

D = "DESCRICAO"

# ======================= FIXED VALUES (begin) =======================

TP_PRODUTOR = Recode(
    rules=(
        ("Produtor Rural PF/PJ", ({D: ("Produtor rural (pessoa física ou jurídica) - (MCR 1-4-1-a)",)},)),
        ("Extrativista", ({D: ("Extrativista (MCR 2-1-15)",)},)),
        ("Pescador", ({D: ("Pescador (MCR 2-1-15 e 20)",)},)),
        ("Sílvicola/Indígena", ({D: ("Silvícola/indígena (MCR 1-4-3)",)},)),
        ("Cooperativa de Produção Agropecuária", ({D: (
            "Cooperativa de produção agropecuária – na condição de sociedade prestadora de serviços de natureza agropecuária aos seus cooperados (MCR 5-1-2-b e c)",
            "Cooperativa de produção agropecuária – na condição de produtor rural - (MCR 5-1-2-a)",
        )},)),
        ("Aquicultor", ({D: ("Aquicultor (MCR 2-1-20)",)},)),
        ("Silvicultor", ({D: ("Silvicultor (MCR 10-2-2-a-III)",)},)),
        ("Produtor PF/PJ de Mudas/Sementes/Embriões", ({D: (
            "Pessoa física ou jurídica produtora de mudas, sementes, sêmen para inseminação artificial e embriões (MCR 1-4-2-a e b)",
        )},)),
        ("Quilombola Rural", ({D: ("Quilombola rural (MCR 10-2-2-b-II)",)},)),
        ("Agroindústria", ({D: ("Agroindústria (MCR 1-4-2A-a)",)},)),
    ),
    default="Outros Produtores",
    null_guard=D,
)

CAT_EMITENTE = Recode(
    rules=((Keep(D), ({D: ("Pequeno Produtor Rural", "Médio Produtor Rural", "Grande Produtor Rural")},)),),
    default="Outras Categorias",
    null_guard=D,
)

INSTRUM_CREDITO = Recode(
    rules=((Keep(D), ({D: (
        "Cédula Rural Pignoratícia", "Cédula Rural Hipotecária", "Cédula Rural Pignoratícia e Hipotecária",
        "Nota de Crédito Rural", "Cédula de Crédito Bancário", "Nota Promissória Rural",
        "Contrato de Crédito Rural",
    )},)),),
    default="Demais Instrumentos de Crédito",
    null_guard=D,
)

FONTE_RECURSO = Recode(
    rules=(("Recursos Controlados", ({D: (
        "RECURSOS LIVRES EQUALIZÁVEIS", "FACULDADE DE APLICAÇÃO - COMPULSÓRIO", "TESOURO NACIONAL",
        "OBRIGATÓRIOS - MCR 6.2", "POUPANÇA RURAL - CONTROLADOS - SUBVENÇÃO ECONÔMICA",
        "POUPANÇA RURAL - CONTROLADOS - CONDIÇÕES MCR 6.2",
        "POUPANÇA RURAL - CONTROLADOS - FATOR DE PONDERAÇÃO",
        "FUNDO CONSTITUCIONAL DE FINANCIAMENTO DO NORTE (FNO)",
        "FUNDO CONSTITUCIONAL DE FINANCIAMENTO DO NORDESTE (FNE)",
        "FUNDO CONSTITUCIONAL DE FINANCIAMENTO DO CENTRO-OESTE (FCO)",
        "BNDES/FINAME - EQUALIZÁVEL", "FAT - FUNDO DE AMPARO AO TRABALHADOR",
        "FUNCAFE-FUNDO DE DEFESA DA ECONOMIA CAFEEIRA", "FUNDO DE TERRAS E DA REFORMA AGRÁRIA", "INCRA",
        "GOVERNOS E FUNDOS ESTADUAIS OU MUNICIPAIS", "PIS/PASEP",
        "INSTR HIBRIDO CAPITAL DÍVIDA-IHCD (Lei 12.793/2013 - Art. 6º) - EQUALIZÁVEL",
        "COMPULSÓRIO SOBRE RECURSOS À VISTA - REFORÇO DO INVESTIMENTO (CIRC 3.745)",
        "LETRA DE CRÉDITO DO AGRONEGÓCIO (LCA) - TAXA FAVORECIDA",
        "Exigibilidade Adicional dos Recursos à Vista - Resolução 5030 ENCERRADO",
        'LETRA DE CRÉDITO DO AGRONEGÓCIO (LCA) - CONTROLADOS - SUBVENÇÃO ECONÔMICA - MCR 6-7-7A-"b"-I',
        "Exigibilidade Adicional dos Recursos à Vista - Resolução 5087 - ENCERRADO",
        "Exigibilidade Adicional dos Recursos à Vista - Resolução 5157",
        "Fundo Nacional sobre Mudança do Clima (Fundo Clima) - RES CMN 5.130/2024",
        "EXIGIBILIDADE ADICIONAL DOS RECURSOS À VISTA", "EXIGIBILIDADE ADICIONAL DA POUPANÇA RURAL",
    )},)),),
    default="Recursos Livres",
    null_guard=None,
)

TIPO_SEGURO = Recode(
    rules=(
        ("Sem seguro", ({D: ("Não se aplica", "Sem adesão a seguro")},)),
        ("Proagro", ({D: ("Proagro mais", "Proagro tradicional")},)),
    ),
    default="Outros seguros",
    null_guard=D,
)

FINALIDADE = Recode(
    rules=((Keep("FINALIDADE"), ({"FINALIDADE": ("Custeio", "Investimento", "Comercialização", "Industrialização")},)),),
    default="Outras finalidades",
)

ATIVIDADE = Recode(
    rules=((Keep("ATIVIDADE"), ({"ATIVIDADE": ("Agrícola", "Pecuário(a)")},)),),
    default="Outras atividades",
)


def _with_purpose(purpose: str, *modalities: str) -> tuple:
    return tuple({"MODALIDADE": (m,), "FINALIDADE": (purpose,)} for m in modalities)


MODALIDADE = Recode(
    rules=(
        ("Manutenção de ciclo", ({"MODALIDADE": (
            "APICULTURA", "AQUISIÇÃO E MANUTENÇÃO DE ANIMAIS", "AVICULTURA", "BUBALINOCULTURA",
            "CAPRINOCULTURA", "CRIA DE ANIMAIS", "CUNICULTURA E DEMAIS ROEDORES", "EQUINOCULTURA",
            "EXPLORAÇÃO SOB REGIME DE INTEGRAÇÃO - ENCERRADO", "LAVOURA",
            "MANUTENÇÃO/CRIAÇÃO DE ANIMAIS (CRIA)", "MANUTENÇÃO/CRIAÇÃO DE ANIMAIS (RECRIA E ENGORDA)",
            "MINHOCULTURA", "OVINOCULTURA", "SERICICULTURA", "SUINOCULTURA",
            "Agroindústria Familiar (MCR 10-11)",
        )},) + _with_purpose(
            "Custeio", "AQUICULTURA", "BOVINOCULTURA", "EXTRATIVISMO DE ESPÉCIES NATIVAS",
            "FLORESTAMENTO E REFLORESTAMENTO", "PASTAGEM", "AQUISIÇÃO DE INSUMOS PARA INDÚSTRIA FAMILIAR",
            "BENEFICIAMENTO OU INDUSTRIALIZAÇÃO", "PESCA", "SERVIÇOS PROFISSIONAIS/TÉCNICOS",
        )),
        ("Investimento em máquinas/infraestrutura/ativos", ({"MODALIDADE": (
            "AQUISIÇÃO DE ATIVOS OPERACIONAIS", "AQUISIÇÃO DE PROPRIEDADES RURAIS", "AQUISIÇÃO DE VEÍCULOS",
            "Financiamento para Aquisição da Produção/Materia P", "MELHORAMENTO DAS EXPLORAÇÕES",
            "MÁQUINAS, EQUIPAMENTOS, MATERIAIS E UTENSÍLIOS",
        )},) + _with_purpose(
            "Investimento", "AQUICULTURA", "EXTRATIVISMO DE ESPÉCIES NATIVAS",
            "AQUISIÇÃO DE INSUMOS PARA INDÚSTRIA FAMILIAR", "BENEFICIAMENTO OU INDUSTRIALIZAÇÃO", "PESCA",
            "SERVIÇOS PROFISSIONAIS/TÉCNICOS",
        )),
        ("Investimento em material biológico", ({"MODALIDADE": (
            "AQUISIÇÃO DE ANIMAIS", "AQUISIÇÃO DE ANIMAIS DE SERVIÇO",
            "AQUISIÇÃO DE ANIMAIS DE SERVIÇO (USO AGRICULTURA)", "FORMAÇÃO DE CULTURAS PERENES",
            "IMPLANTAÇÃO E MELHORAMENTO",
        )},) + _with_purpose("Investimento", "BOVINOCULTURA", "PASTAGEM")),
        ("Estocagem/processamento/proteção de preço", ({"MODALIDADE": (
            "Aquisição de Matéria Prima direto do Produtor/Coop", "CPR (CÉDULA DE PRODUTO RURAL)",
            "DESCONTO (NPR E DR)", "ESTOCAGEM", "FAC - Financiamento para Aquisição de Café", "FEE (EX-LEC)",
            "FEPM (EX-EGF) - encerrado", "FGPP-Financiamento para Garantia de Preços ao Prod",
            "FINANCIAMENTO PARA PROTEÇÃO DE PREÇOS EM OPERAÇÕES", "PRÉ-COMERCIALIZAÇÃO - encerrado",
        )},) + _with_purpose("Comercialização", "AQUICULTURA", "PESCA", "SERVIÇOS PROFISSIONAIS/TÉCNICOS")),
        ("Cooperativismo/linhas de apoio", ({"MODALIDADE": (
            "ATENDIMENTO A COOPERADOS", "COOPERATIVAS DE CRÉDITO (SINGULAR OU CENTRAL) - en",
            "Crédito para Cooperativa Pronaf MCR 10-3-1A", "FINANCIAMENTO PROCAP-AGRO",
            "INTEGRALIZAÇÃO DE COTAS PARTES",
        )},)),
    ),
    default="Outras modalidades",
    null_guard="MODALIDADE",
)

P = "PRODUTO"
PRODUTO = Recode(
    rules=(
        (Keep(P), ({P: ("SOJA", "ARROZ", "FEIJÃO", "AGROARTESANATO", "AGROINDÚSTRIA")},)),
        ("MILHO", ({P: ("MILHO", "MILHO SILAGEM")},)),
        ("TRIGO", ({P: ("TRIGO", "TRIGO SILAGEM", "TRIGO SARRACENO/MOURISCO")},)),
        ("ALGODÃO", ({P: ("ALGODÃO", "CAROÇO DE ALGODÃO")},)),
        ("CAFÉ", ({P: ("CAFÉ", "RECUPERAÇÃO DE CAFEZAIS")},)),
        ("BOVINOCULTURA", ({P: (
            "BOVINOS", 'Confinamento de bovinos "free stall', "SEBO BOVINO",
            "Aquisição de Sistemas para Rastreabilidade de bovinos e bubalinos",
        )},)),
        ("SUÍNOCULTURA", ({P: ("GRANJAS DE SUÍNOS", "SUINOCULTURA", "SUÍNOS")},)),
        ("FRUTICULTURA", ({P: (
            "ABACATE", "ABACAXI", "ABRICÓ (DAMASCO)", "ACEROLA", "AMEIXA", "AMORA", "ARAÇA", "ATEMOIA", "AÇAÍ",
            "BABAÇU", "BANANA", "BURITI", "CACAU", "CAMU-CAMU", "CAJU", "CAJÁ", "CAMAPU (PHYSALIS)", "CAQUI",
            "CARAMBOLA", "CEREJA", "CHERIMOIA", "CIDRA", "COCO", "COCO-DA-BAIA", "CUPUAÇU", "FIGO", "FRAMBOESA",
            "FRUTAS DIVERSAS N. E.", "GABIROBA", "GOIABA", "GRAVIOLA", "GROSELHA", "GUARANÁ", "JABUTICABA",
            "JACA", "JILÓ", "LARANJA", "LIMA", "LIMÃO", "LONGAN", "MAMÃO", "MANGA", "MANGABA", "MANGOSTÃO",
            "MARACUJÁ", "MARMELO", "MAÇÃ", "MELANCIA", "MELÃO", "MIRTILO", "MORANGO", "MURICI", "NECTARINA",
            "NESPERA", "PEQUI", "PERA", "PINHA (ATA, FRUTA-DO-CONDE, ANONA)", "PITANGA", "PITAYA", "POMELO",
            "PÊSSEGO", "QUIUÍ (KIWI)", "ROMÃ", "SAPOTI", "TAMARINDO", "TANGERINA", "TAPEREBÁ", "TORANJA",
            "TUCUM", "UMBU", "UVA", "CÂMARA FRIA PARA ARMAZENAMENTO DE FRUTAS",
        )},)),
        ("OLERICULTURA/HORTALIÇAS", ({P: (
            "ABOBRINHA", "ABÓBORA-MORANGA", "ACELGA", "AGRIÃO", "AIPO", "ALCACHOFRA", "ALFACE", "ALFAFA", "ALHO",
            "ALHO PORÓ", "ALMEIRÃO", "ASPARGO", "BATATA", "BATATA ASTERIX", "BATATA-DOCE", "BATATA-INGLESA",
            "BERINJELA", "BETERRABA", "BRÓCOLOS (BRÓCOLIS)", "CARÁ", "CEBOLA", "CEBOLINHA", "CEBOLINHA VERDE",
            "CENOURA", "CHICORIA", "CHUCHU", "COENTRO", "COUVE", "COUVE-FLOR", "ESCAROLA", "ESPINAFRE",
            "HORTALIÇAS", "Hortaliça ora-pro-nóbis", "INHAME", "MANDIOCA (AIPIM, MACAXEIRA)",
            "MANDIOQUINHA (BATATA: BAROA, SALSA, AIPO)", "MAXIXE", "MOSTARDA", "NABO", "OLERÍCOLAS", "PEPINO",
            "PIMENTÃO", "QUIABO", "RABANETE", "REPOLHO", "RÚCULA", "SALSA", "TAIOBA", "TOMATE", "VAGEM",
        )},)),
        ("AQUICULTURA/PESCADO", ({P: (
            "ALGICULTURA (Cultivo de Algas)", "Alevinos", "Algas", "Alimentador de Peixe", "CAMARÃO",
            "CAMARÃO E/OU LAGOSTA", "CARCINICULTURA", "CARCINICULTURA (Cultivo de Camarão e Lagosta)",
            "CRUSTÁCEOS", "MEXILHÃO", "MARISCOS", "Camarão e Lagosta", "Descamadora de Peixe",
            "Descascador de Camarão e Lagosta", "Girinos", "MALACOCULTURA (Cultivo e Criação de Moluscos)",
            "MARICULTURA (Cultivo de Marisco)", "Mariscos", "PESCADO IN NATURA",
            "MITILICULTURA (Cultivo de Mexilhão)", "MOLUSCOS (Caramujos, Lulas etc)", "Mexilhões", "OSTRAS",
            "OSTREICULTURA", "OSTREICULTURA (Cultivo de Ostras)", "PEIXE", "PESCA", "PESCADO", "PISCICULTURA",
            "RÃ", "RANICULTURA",
            "PESCADO (ARMAZENAMENTO, ACONDICIONAMENTO E PRESERVACAO, INCLUSIVE SEGURO, IMPOSTOS, FRETES ETC)",
            "PISCICULTURA (CULTIVO DE PEIXES)", "PISCICULTURA (Cultivo de Peixe)", "RANICULTURA (Cultivo de Rã)",
            "Petrechos para Pesca (anzóis, iscas, cordas, bóias, combustivel, redes, mão-de-obra etc)",
            "Aerador", "Armação para Barco de Pesca", "CLASSIFICADOR DE PESCADO", "COZEDOR DE PESCADO",
            "DEPÓSITO PARA RAÇÕES", "DESPOLPADOR DE PESCADO", "Embarcação Grande (a partir de 100 A/B)",
            "Embarcação Média (acima de 20 e abaixo de 100 A/B)", "Embarcação Pequena (até 20 A/B)", "Esteira",
            "Estufa", "Evisceradora", "MESA PARA DESCABEÇAMENTO DE PESCADO",
            "MESA PARA RETIRADA DE PELE, ESCAMA E CARCAÇA DE PESCADO", "Mesa para Filetagem",
            "SEPARADOR DE RESÍDUOS", "Tanques Escavados", "Tanques Redes",
            "PRODUTOS AQUICOLAS (Armazenamento, Acondicionamento e Preservação, inclusive Seguro, Impostos etc)",
            "Unidade de Beneficiamento ou Processamento",
        )},)),
        ("OUTRAS PECUÁRIAS", ({P: (
            "ABELHA", "APICULTURA", "ANIMAIS SILVESTRES", "ASININOS", "AVESTRUZ", "BICHO-DA-SEDA",
            "BÚFALOS (BUBALINOS)", "CANINOS", "CAPRINOS", "CHINCHILAS", "COELHO", "CUNICULTURA", "EQUINOS", "LÃ",
            "MEL", "MINHOCA", "MELIPONICULTURA",
            "Caixas de abelhas, favos, centrifugas p/ extração de mel, fumegadores",
            "Instalações para Aves, Suínos e Coelhos", "MUARES", "OUTROS ANIMAIS", "OVINOS", "SERICICULTURA",
            "SIRGARIAS", "TRIPAS", "VISCACHAS", "COURO", "LEITE", "Balança para Animais", "Caminhões Frigoríficos",
            "INSEMINAÇÃO ARTIFICIAL", "Matrizes e Reprodutores", "Medicamentos, Rações e Insumos",
            "RESÍDUOS DE PRODUÇÃO ANIMAL", "Raspador", "SAL", "VACINAS, SAIS MINERAIS E MEDICAMENTOS",
        )},)),
        ("SILVICULTURA/EXTRATIVISMO", ({P: (
            "ACÁCIA NEGRA", "AGAVE (SISAL)", "ANDIROBA", "ARAUCÁRIA", "BUCHA VEGETAL", "Bambu", "BARU",
            "CASTANHA DE BARU", "CASTANHA DE CAJU", "CASTANHA-DO-BRASIL", "CAMBARÁ", "CARNAÚBA", "CEDRINHO",
            "CEDRO", "CURAUÁ", "DENDÊ", "Cumaru/Champanhe", "EUCALIPTO", "GARAPEIRA", "GUARIROBA", "JATOBÁ",
            "JUTA", "Kiri (Paulownia spp)", "LINHO", "MADEIRA", "MURUMURU", "Macaúba", "NOZ", "OLIVA (AZEITONA)",
            "PALMITO (PUPUNHA,AÇAI)", "PARICÁ", "PIAÇABA (PIAÇAVA)", "PINHÃO", "PINUS", "PORONGO (CUIA,CABAÇA)",
            "PRACAXI", "PUPUNHA", "RAMI", "SERINGUEIRA", "TUNGUE", "VIME", "ÓLEO VEGETAL", "TANINO",
            "EQUIPAMENTOS E UTENSÍLIOS PARA EXTRATIVISMO DE ESPÉCIES NATIVAS",
        )}, {P: ("FLORESTAMENTO E REFLORESTAMENTO",), "VARIEDADE": (
            "EUCALIPTO DUNNII", "EUCALIPTO GRANDIS", "EUCALIPTO GLOBULUS", "EUCALIPTO SALIGNA",
            "EUCALIPTO VIMINALIS", "EUCALIPTO BENTHAMII",
        )})),
        ("OUTROS GRÃOS/OLEAGINOSAS", ({P: (
            "AMENDOIM", "AVEIA", "CANOLA", "CARINATA", "CENTEIO", "CEVADA", "CHIA", "COLZA", "ERVILHA",
            "GERGELIM", "GIRASSOL", "GRÃO-DE-BICO", "GRÃOS", "LENTILHA", "LICHIA (LECHIA)", "LINHAÇA", "LÚPULO",
            "PAINÇO", "QUINOA",
        )},)),
        ("CONDIMENTOS/ERVAS MEDICINAIS", ({P: (
            "AROEIRA (PIMENTA-ROSA)", "AÇAFRÃO", "CHÁ", "COPAÍBA", "CRAVO", "CRAVO-DA-ÍNDIA",
            "ERVA CIDREIRA (MELISSA)", "ERVA-DOCE", "ERVA-MATE", "Ervas medicinais, aromáticas ou condimentares",
            "GENGIBRE", "HORTELÃ", "MALVA", "MANJERICÃO", "MENTA", "MORINGA", "NEEM", "PATAUÁ", "PIMENTA",
            "PIMENTA-DO-REINO", "PIXURIM", "POEJO", "SERRALHA", "URUCUM",
        )},)),
        ("AVICULTURA", ({P: ("AVES", "AVES EXCETO GALINÁCEOS", "AVICULTURA", "FRANGO", "GALINÁCEOS",
                             "GRANJAS AVÍCOLAS", "OVOS")},)),
        ("PASTAGENS/FORRAGENS", ({P: (
            "AZEVEM", "CAPIM", "CROTALÁRIA", "ERVILHACA - RALIÇA, VICIA SATIVA", "ESTILOSANTES",
            "FORRAÇÃO DE JARDIM", "MAMONA", "MILHETO", "NIGER", "PALMA", "PASTAGEM", "SORGO", "TIFTON",
            "TRITICALE",
        )},)),
        ("OUTRAS CULTURAS", ({P: (
            "CITRONELA (CYMBOPOGON NARDUS)", "COGUMELO", "ESTÉVIA", "FLORESTAMENTO - TRATOS CULTURAIS",
            "FLORESTAMENTO E REFLORESTAMENTO", "FUMO", "MUDAS DIVERSAS", "OUTRAS CULTURAS", "OUTRAS LAVOURAS",
            "PLANTAS PARA INFUSÃO",
            "ADUBAÇÃO ORGÂNICA/MINERAL, CALAGEM, SUBSTRATOS INERTES(PEDRA, AREIA, VERMICULITA, SILTE, ARGILA ETC)",
            "AQUISIÇÃO DE FERRAMENTA PORTÁTIL MANUAL PARA TRATOS CULTURAIS", "CONSERVAÇÃO DE SOLOS",
            "CERCAS, ARAMADOS, TELHAS, TELAS PARA SOMBREAMENTO E COBERTURAS DE SOLO",
            "COBERTURAS DE SOLO (PLÁSTICAS, TNT, TECIDOS, SERRAGEM, PALHADAS DE CAPIM E DE GRÃOS ETC)",
            "DESPOLPADOR", "CANA-DE-AÇÚCAR", "AÇUCAR", "EQUIPAMENTOS E UTENSILIOS PARA AGRICULTURA DE PRECISÃO",
            "ESTUFAS/VIVEIROS (ILUMIN. ARTIFICIAL, MUDAS, SEMENTES, SACOS, TALAGARÇAS, BANDEJAS, VASOS)",
            "HIDROPONIA/FAZENDA VERTICAL (ALVENARIA, MADEIRA, AÇO, ETC)",
            "IRRIGAÇÃO/LIXIVIAÇÃO (GOTEJADOR, ASPERSOR, NEBULIZADOR, EXAUSTOR, VENTILADOR, MANGUEIRAS, CANAIS ET)",
            "SECADOR",
            "TENDA, GALPÃO, TÚNEL PLÁSTICO (ABRANGE LONAS, FILMES, LONGARINAS, ESTACAS E MAT. SUSTENTAÇÃO)",
            "TULHA",
        )}, {P: ("AQUISIÇÃO DE INSUMOS",), "MODALIDADE": ("LAVOURA",)})),
        ("ORNAMENTAIS", ({P: ("CRISÂNTEMO", "FLORES", "GRAMA", "PALMEIRA", "PALMÁCEA", "PLANTAS ORNAMENTAIS",
                              "SANSÃO-DO-CAMPO")},)),
    ),
    default="OUTROS PRODUTOS",
    null_guard=P,
)

PROGRAMA = Recode(
    rules=(
        ("PRONAF", ({"CD_PROGRAMA": ("0001",)},)),
        ("PRONAMP", ({"CD_PROGRAMA": ("0050",)},)),
    ),
    default="DEMAIS PROGRAMAS",
    null_guard="CD_PROGRAMA",
)

# The original has a second branch (drought-cover irrigation -> 'Cobertura contra a
# seca') after this one; it can never fire because this branch already keeps every
# description outside the two listed, so only the effective rules are kept.
TIPO_IRRIGACAO = Recode(
    rules=((Keep(D), ({D: Not(("Não Irrigado", "Não se aplica"))},)),),
    default="Não irrigado/Não se aplica",
    null_guard=D,
)

TIPO_AGRICULTURA = Recode(
    rules=(("Não se aplica", ({D: ("Não se aplica", "Floresta Plantada", "Floresta Nativa")},)),),
    default=Keep(D),
    null_guard=D,
)

TIPO_CICLO = Recode(
    rules=(
        ("Cria/Recria", ({D: ("Creche - ENCERRADO", "Cria ou Multiplicação", "Cria/Creche - ENCERRADO",
                              "Retenção de Matrizes", "Cria/Recria", "Recria")},)),
        ("Engorda", ({D: ("Engorda", "Terminação - ENCERRADO", "Engorda em confinamento")},)),
        ("Ciclo completo", ({D: ("Cria/Recria/Engorda (Ciclo Completo)", "Cria/Recria/Engorda - ENCERRADO",
                                 "Cria e Engorda", "Recria e Engorda", "Recria/Terminação - ENCERRADO")},)),
        ("Corte", ({D: ("Corte Raso Final", "Corte Raso Intermediário - ENCERRADO", "Demais Cortes - ENCERRADO",
                        "Primeiro Corte - ENCERRADO", "Segundo Corte - ENCERRADO", "Terceiro Corte - ENCERRADO",
                        "Quarto Corte - ENCERRADO")},)),
        (Keep(D), ({D: ("Semestral", "Anual", "Bienal")},)),
    ),
    default="Outros ciclos",
    null_guard=D,
)

# ======================== FIXED VALUES (end) ========================
