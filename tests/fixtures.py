"""Report documents written for these tests."""


def report(report_id, section, tumor="T1", icd="C61", version="10 2023 GM", date="2020-03-01"):
    stamp = f"<Diagnosedatum>{date}</Diagnosedatum>" if date else ""
    year = f"<Version>{version}</Version>" if version else ""
    return f"""<Meldung Meldung_ID="{report_id}"><Meldebegruendung>I</Meldebegruendung>
      <Tumorzuordnung Tumor_ID="{tumor}"><Primaertumor_ICD><Code>{icd}</Code>{year}</Primaertumor_ICD>
      {stamp}<Seitenlokalisation>L</Seitenlokalisation></Tumorzuordnung>{section}</Meldung>"""


def document(patient_id, *reports, recorded="2024-05-01", sex="M"):
    return f"""<?xml version="1.0" encoding="UTF-8"?>
    <oBDS xmlns="http://www.basisdatensatz.de/oBDS/XML" Schema_Version="3.0.2">
    <Meldedatum>{recorded}</Meldedatum><Menge_Patient><Patient Patient_ID="{patient_id}">
    <Patienten_Stammdaten><Geschlecht>{sex}</Geschlecht>
    <Geburtsdatum Datumsgenauigkeit="M">1950-05-01</Geburtsdatum>
    <Adresse><Land>de</Land><PLZ/></Adresse></Patienten_Stammdaten>
    <Menge_Meldung>{''.join(reports)}</Menge_Meldung></Patient></Menge_Patient></oBDS>"""


DIAGNOSIS = """<Diagnose><Primaertumor_Topographie_ICD_O><Code>C61.9</Code><Version>32</Version></Primaertumor_Topographie_ICD_O>
  <Diagnosesicherung>7</Diagnosesicherung>
  <Menge_Fruehere_Tumorerkrankung><Fruehere_Tumorerkrankung><Freitext>Hautkrebs</Freitext><Diagnosedatum>1999</Diagnosedatum></Fruehere_Tumorerkrankung>
  <Fruehere_Tumorerkrankung><Diagnosedatum>1998</Diagnosedatum></Fruehere_Tumorerkrankung></Menge_Fruehere_Tumorerkrankung>
  <Histologie Histologie_ID="H1"><Tumor_Histologiedatum Datumsgenauigkeit="T">2020-02-10</Tumor_Histologiedatum>
  <Morphologie_ICD_O><Code>8140/3</Code><Version>32</Version></Morphologie_ICD_O>
  <Morphologie_ICD_O><Code>8140/3</Code><Version>33</Version></Morphologie_ICD_O>
  <Grading>2</Grading><LK_untersucht>12</LK_untersucht><LK_befallen>0</LK_befallen></Histologie>
  <Menge_FM><Fernmetastase><Diagnosedatum Datumsgenauigkeit="V">2020-01-01</Diagnosedatum><Lokalisation>OSS</Lokalisation></Fernmetastase>
  <Fernmetastase><Lokalisation/></Fernmetastase></Menge_FM>
  <cTNM ID="T7"><Datum>2020-02-01</Datum><Version>8</Version><T>2</T><c_p_u_Praefix_N>p</c_p_u_Praefix_N><N>1(sn)(i+)</N><M>0</M><UICC_Stadium>IIA</UICC_Stadium></cTNM>
  <Menge_Genetik><Genetische_Variante><Bezeichnung>BRCA2</Bezeichnung><Sonstige_Auspraegung>selten</Sonstige_Auspraegung></Genetische_Variante></Menge_Genetik>
  <Menge_Weitere_Klassifikation><Weitere_Klassifikation><Datum>2020-02-03</Datum><Name>FIGO</Name><Stadium>II</Stadium></Weitere_Klassifikation></Menge_Weitere_Klassifikation>
  <Allgemeiner_Leistungszustand>80%</Allgemeiner_Leistungszustand>
  <Modul_Prostata><GleasonScore><GradPrimaer>3</GradPrimaer><GradSekundaer>4</GradSekundaer></GleasonScore>
  <AnlassGleasonScore>S</AnlassGleasonScore><AnzahlStanzen>12</AnzahlStanzen><CaBefallStanze><U>U</U></CaBefallStanze>
  <PSA>4.50</PSA><DatumPSA>2020-01-15</DatumPSA></Modul_Prostata>
  <Modul_Allgemein><Studienteilnahme><NU>N</NU></Studienteilnahme></Modul_Allgemein></Diagnose>"""


def radiotherapy(reason, finish=""):
    done = f"<Ende>{finish}</Ende>" if finish else ""
    return f"""<ST ST_ID="R 1"><Meldeanlass>{reason}</Meldeanlass><Intention>K</Intention><Stellung_OP>A</Stellung_OP>
    <Menge_Bestrahlung><Bestrahlung><Beginn>2021-01-05</Beginn></Bestrahlung>
    <Bestrahlung><Beginn>2021-02-01</Beginn>{done}<Applikationsart><Perkutan>
    <Zielgebiet><CodeVersion2021>6.4</CodeVersion2021></Zielgebiet><Seite_Zielgebiet>L</Seite_Zielgebiet>
    <Strahlenart>UH</Strahlenart><Radiochemo>RCN</Radiochemo><Atemgetriggert>4D</Atemgetriggert>
    <Gesamtdosis><Dosis>50.40</Dosis><Einheit>Gy</Einheit></Gesamtdosis></Perkutan></Applikationsart></Bestrahlung>
    </Menge_Bestrahlung></ST>"""


SYSTEMIC = """<SYST SYST_ID="S_1"><Meldeanlass>behandlungsbeginn</Meldeanlass><Intention>P</Intention>
  <Therapieart>CH</Therapieart><Beginn Datumsgenauigkeit="T">2021-06-01</Beginn><Menge_Substanz>
  <Substanz><ATC><Code>L01FF05</Code><Version>2020</Version></ATC></Substanz>
  <Substanz><Bezeichnung>Bicalutamid</Bezeichnung></Substanz><Substanz><Bezeichnung>Neu-1</Bezeichnung></Substanz>
  </Menge_Substanz><Nebenwirkungen><Grad_maximal2_oder_unbekannt>U</Grad_maximal2_oder_unbekannt></Nebenwirkungen></SYST>"""

SURGERY = """<OP OP_ID="O1"><Intention>K</Intention><Menge_OPS><OPS><Code>5-604.02</Code><Version>2021</Version></OPS>
  <OPS><Code>5-604.02</Code><Version>2023</Version></OPS><OPS><Code>1-100</Code></OPS></Menge_OPS>
  <Residualstatus><Gesamtbeurteilung_Residualstatus>R0</Gesamtbeurteilung_Residualstatus></Residualstatus>
  <Modul_Prostata><KomplPostOP_ClavienDindo>N</KomplPostOP_ClavienDindo></Modul_Prostata></OP>"""


def death(date=""):
    day = f"<Sterbedatum>{date}</Sterbedatum>" if date else ""
    return f'<Tod Abschluss_ID="A1">{day}<Tod_tumorbedingt>J</Tod_tumorbedingt></Tod>'


BOARD = """<Tumorkonferenz Tumorkonferenz_ID="K1"><Meldeanlass>behandlungsende</Meldeanlass><Datum>2020-05-25</Datum>
  <Therapieempfehlung><Menge_Typ_Therapieempfehlung><Typ_Therapieempfehlung>OP</Typ_Therapieempfehlung>
  </Menge_Typ_Therapieempfehlung><Abweichung_Patientenwunsch>N</Abweichung_Patientenwunsch></Therapieempfehlung></Tumorkonferenz>"""
