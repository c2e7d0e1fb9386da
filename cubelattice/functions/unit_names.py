"""Names of units of measure."""

#: Label (lower case, without marks), code, symbol, English name.
UNITS = [
    ("numar persoane", "PERSONS", "pers.", "Persons"),
    ("persoane", "PERSONS", "pers.", "Persons"),
    ("numar", "NUMBER", "nr.", "Number"),
    ("mii persoane", "THOUSAND_PERSONS", "mii pers.", "Thousands of persons"),
    ("mii", "MII", "", "Thousands"),
    ("bucati", "BUCATI", "buc.", "Pieces"),
    ("mii bucati", "MII_BUCATI", "mii buc.", "Thousands of pieces"),
    ("locuri", "LOCURI", "", "Places/Seats"),
    ("mii locuri", "THOUSAND_PLACES", "mii loc.", "Thousands of places"),
    ("numar linii", "NUMAR_LINII", "", "Number of lines"),
    ("numar locuri-zile", "NUMAR_LOCURIZILE", "", "Place-days"),
    ("numar spectacole", "NUMAR_SPECTACOLE", "", "Number of shows"),
    ("numar spectatori", "NUMAR_SPECTATORI", "", "Number of spectators"),
    ("mii spectatori", "MII_SPECTATORI", "", "Thousands of spectators"),
    ("mii exemplare", "MII_EXEMPLARE", "", "Thousands of copies"),
    ("numar mediu la 100 gospodarii", "NUMAR_MEDIU_LA_100_GOSPODARII", "", "Average per 100 households"),
    ("procente", "PERCENT", "%", "Percent"),
    ("procent", "PERCENT", "%", "Percent"),
    ("%", "PERCENT", "%", "Percent"),
    ("promile", "PROMILE", "‰", "Per mille"),
    ("la mie", "PROMILE", "‰", "Per mille"),
    ("indice", "INDEX", "", "Index"),
    ("rata", "RATE", "", "Rate"),
    ("coeficient", "COEFFICIENT", "", "Coefficient"),
    ("anul 2020", "ANUL_2020", "", "Year 2020 (base)"),
    ("nascuti vii la 1000 locuitori", "NASCUTI_VII_LA_1000_LOCUITORI", "", "Live births per 1000 inhabitants"),
    ("nascuti vii la 1000 femei in varsta fertila", "NASCUTI_VII_LA_1000_FEMEI_IN_VARSTA_FERTILA", "", "Live births per 1000 women of fertile age"),
    ("nascuti morti la 1000 nascuti", "NASCUTI_MORTI_LA_1000_NASCUTI", "", "Stillbirths per 1000 births"),
    ("decedati la 1000 locuitori", "DECEDATI_LA_1000_LOCUITORI", "", "Deaths per 1000 inhabitants"),
    ("decedati sub 1 an la 1000 nascuti vii", "DECEDATI_SUB_1_AN_LA_1000_NASCUTI_VII", "", "Infant deaths per 1000 live births"),
    ("casatorii la 1000 locuitori", "CASATORII_LA_1000_LOCUITORI", "", "Marriages per 1000 inhabitants"),
    ("divorturi la 1000 locuitori", "DIVORTURI_LA_1000_LOCUITORI", "", "Divorces per 1000 inhabitants"),
    ("spor natural la 1000 locuitori", "SPOR_NATURAL_LA_1000_LOCUITORI", "", "Natural increase per 1000 inhabitants"),
    ("la 1000 femei", "LA_1000_FEMEI", "", "Per 1000 women"),
    ("la 1000 nascuti-vii", "LA_1000_NASCUTIVII", "", "Per 1000 live births"),
    ("cazuri noi la 100000 locuitori", "CAZURI_NOI_LA_100000_LOCUITORI", "", "New cases per 100000 inhabitants"),
    ("rate la 1000 locuitori", "RATE_LA_1000_LOCUITORI", "", "Rates per 1000 inhabitants"),
    ("ha", "HECTARES", "ha", "Hectares"),
    ("hectare", "HECTARES", "ha", "Hectares"),
    ("mii hectare", "MII_HECTARE", "mii ha", "Thousands of hectares"),
    ("kilometri", "KILOMETRI", "km", "Kilometers"),
    ("metri patrati", "METRI_PATRATI", "m²", "Square meters"),
    ("m.p. arie desfasurata", "METRI_PATRATI_ARIE_DESFASURATA", "m²", "Square meters (developed area)"),
    ("metri patrati arie desfasurata", "METRI_PATRATI_ARIE_DESFASURATA", "m²", "Square meters (developed area)"),
    ("metri patrati suprafata utila", "METRI_PATRATI_SUPRAFATA_UTILA", "m²", "Square meters (usable area)"),
    ("litri", "LITERS", "l", "Liters"),
    ("mii litri", "THOUSAND_LITERS", "mii l", "Thousands of liters"),
    ("metri cubi", "METRI_CUBI", "m³", "Cubic meters"),
    ("mii metri cubi", "MII_METRI_CUBI", "mii m³", "Thousands of cubic meters"),
    ("milioane metri cubi", "MILIOANE_METRI_CUBI", "mil. m³", "Millions of cubic meters"),
    ("milioane metri cubi 15 gr. c 760 mm hg", "MILIOANE_METRI_CUBI_15_GR_C_760_MM_HG", "", "Millions of cubic meters (15°C, 760mmHg)"),
    ("metri cubi pe zi", "METRI_CUBI_PE_ZI", "m³/zi", "Cubic meters per day"),
    ("10000 hl", "10000_HL", "10000 hl", "10000 hectoliters"),
    ("kg", "KG", "kg", "Kilograms"),
    ("kilograme", "KG", "kg", "Kilograms"),
    ("kilograme substanta activa", "KILOGRAME_SUBSTANTA_ACTIVA", "kg", "Kilograms of active substance"),
    ("tone", "TONS", "t", "Tons"),
    ("mii tone", "THOUSAND_TONS", "mii t", "Thousands of tons"),
    ("mii tone (gg)", "MII_TONE_GG", "Gg", "Thousands of tons (Gg)"),
    ("tone (mg)", "TONE_MG", "Mg", "Tons (Mg)"),
    ("tone (mg) echivalent co2", "TONE_MG_ECHIVALENT_CO2", "Mg CO2eq", "Tons (Mg) CO2 equivalent"),
    ("tone (mg) echivalent n2o", "TONE_MG_ECHIVALENT_N2O", "Mg N2O eq", "Tons (Mg) N2O equivalent"),
    ("tone 100% substanta activa", "TONE_100_SUBSTANTA_ACTIVA", "t", "Tons 100% active substance"),
    ("tone dw", "TONE_DW", "t DW", "Tons (dry weight)"),
    ("tone o2/ zi", "TONE_O2_ZI", "t O2/zi", "Tons O2 per day"),
    ("tone registru brut", "TONE_REGISTRU_BRUT", "TRB", "Gross register tons"),
    ("tone/tone", "TONETONE", "", "Tons per tons (ratio)"),
    ("tone/mii lei preturile anului 2020", "TONEMII_LEI_PRETURILE_ANULUI_2020", "", "Tons per thousand lei (2020 prices)"),
    ("lei", "LEI", "lei", "Lei (RON)"),
    ("lei ron", "LEI_RON", "lei", "Lei (RON)"),
    ("mii lei", "THOUSAND_LEI", "mii lei", "Thousands of lei"),
    ("mii lei ron", "MII_LEI_RON", "mii lei", "Thousands of lei (RON)"),
    ("milioane lei", "MILLION_LEI", "mil. lei", "Millions of lei"),
    ("milioane lei ron", "MILIOANE_LEI_RON", "mil. lei", "Millions of lei (RON)"),
    ("miliarde lei", "MILIARDE_LEI", "mld. lei", "Billions of lei"),
    ("lei / buc", "LEI__BUC", "lei/buc", "Lei per piece"),
    ("lei / kg", "LEI__KG", "lei/kg", "Lei per kilogram"),
    ("lei / litru", "LEI__LITRU", "lei/l", "Lei per liter"),
    ("lei / ora", "LEI__ORA", "lei/ora", "Lei per hour"),
    ("lei / persoana", "LEI__PERSOANA", "lei/pers", "Lei per person"),
    ("lei  / tona", "LEI__TONA", "lei/t", "Lei per ton"),
    ("lei  / 10 hl", "LEI__10_HL", "lei/10hl", "Lei per 10 hectoliters"),
    ("lei/ fir", "LEI_FIR", "lei/fir", "Lei per strand"),
    ("mii lei preturile anului 2020/tona", "MII_LEI_PRETURILE_ANULUI_2020TONA", "", "Thousands of lei (2020 prices) per ton"),
    ("euro", "EURO", "€", "Euro"),
    ("mii euro", "THOUSAND_EURO", "mii €", "Thousands of euro"),
    ("milioane euro", "MILLION_EURO", "mil. €", "Millions of euro"),
    ("mii dolari (usd)", "MII_DOLARI_USD", "mii $", "Thousands of USD"),
    ("milioane dolari (usd)", "MILIOANE_DOLARI_USD", "mil. $", "Millions of USD"),
    ("ani", "YEARS", "ani", "Years"),
    ("luni", "MONTHS", "luni", "Months"),
    ("zile", "DAYS", "zile", "Days"),
    ("ore", "ORE", "ore", "Hours"),
    ("mii ore", "MII_ORE", "mii ore", "Thousands of hours"),
    ("ore - om", "ORE__OM", "ore-om", "Man-hours"),
    ("zile-turist", "TOURIST_DAYS", "zile-turist", "Tourist days"),
    ("gigacalorii", "GIGACALORII", "Gcal", "Gigacalories"),
    ("mii gigacalorii", "MII_GIGACALORII", "mii Gcal", "Thousands of gigacalories"),
    ("terrajouli", "TERRAJOULI", "TJ", "Terajoules"),
    ("mii kilowatti", "MII_KILOWATTI", "mii kW", "Thousands of kilowatts"),
    ("milioane kilowatti-ora", "MILIOANE_KILOWATTIORA", "mil. kWh", "Millions of kilowatt-hours"),
    ("kg echivalent petrol", "KG_ECHIVALENT_PETROL", "kgep", "Kilograms of oil equivalent"),
    ("mii tone echivalent petrol", "MII_TONE_ECHIVALENT_PETROL", "mii tep", "Thousands of tons of oil equivalent"),
    ("mii pasageri", "MII_PASAGERI", "mii pas.", "Thousands of passengers"),
    ("milioane pasageri-km", "MILIOANE_PASAGERIKM", "mil. pas-km", "Millions of passenger-kilometers"),
    ("mii tone-kilometru", "MII_TONEKILOMETRU", "mii t-km", "Thousands of ton-kilometers"),
    ("milioane tone-km", "MILIOANE_TONEKM", "mil. t-km", "Millions of ton-kilometers"),
    ("mii vehicule-km", "MII_VEHICULEKM", "mii veh-km", "Thousands of vehicle-kilometers"),
    ("numar sosiri", "ARRIVALS", "sosiri", "Arrivals"),
    ("numar innoptari", "OVERNIGHT_STAYS", "înnoptări", "Overnight stays"),
    ("cai putere", "CAI_PUTERE", "CP", "Horsepower"),
    ("milioane linii echivalente echipate", "MILIOANE_LINII_ECHIVALENTE_ECHIPATE", "", "Millions of equipped equivalent lines"),
    ("echivalent norma intreaga(eni)", "ECHIVALENT_NORMA_INTREAGAENI", "ENI", "Full-time equivalent (FTE)"),
    ("1000 unitati anuale de munca (uam)", "1000_UNITATI_ANUALE_DE_MUNCA_UAM", "mii UAM", "Thousands of annual work units (AWU)"),
]
