"""Converters of article XML on small documents of each format."""

from corvina.sources import article_xml as ax


def one(kind, xml):
    got = ax.FORMATS[kind](ax.tree(xml))
    return got[0] if got else None


def test_medline():
    xml = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID Version="1">123</PMID><OtherID Source="NLM">PMC77 [x]</OtherID>
    <Article><Journal><ISSN IssnType="Electronic">1111-2222</ISSN><JournalIssue><Volume>3</Volume><Issue>4</Issue><PubDate><MedlineDate>2001 Jan-Feb</MedlineDate></PubDate></JournalIssue><Title>J Kidney</Title></Journal>
    <ArticleTitle>A <i>study</i> of mice</ArticleTitle><Pagination><MedlinePgn>7-9</MedlinePgn></Pagination><Abstract><AbstractText Label="AIM">To see.</AbstractText><AbstractText Label="END">Seen.</AbstractText></Abstract>
    <AuthorList><Author><LastName>Vosek</LastName><ForeName>Jana</ForeName></Author><Author><CollectiveName>Tamu Group</CollectiveName></Author></AuthorList><Language>eng</Language>
    <PublicationTypeList><PublicationType>Editorial</PublicationType></PublicationTypeList></Article><MedlineJournalInfo><NlmUniqueID>55</NlmUniqueID><ISSNLinking>3333-4444</ISSNLinking></MedlineJournalInfo>
    <MeshHeadingList><MeshHeading><DescriptorName>Mice</DescriptorName></MeshHeading><MeshHeading><DescriptorName>Rats</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>
    <PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/x</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"""
    a = one("medline", xml)
    assert (a["externalId"], a["pmcId"], a["year"], a["doi"], a["eIssn"], a["printIssn"]) == ("PMID123", "77", "2001", "10.1/x", "1111-2222", "3333-4444")
    assert a["title"] == "A study of mice" and a["authors"] == "Vosek, Jana; Tamu Group, " and a["keywords"] == "Mice/Rats" and a["articleType"] == "other"
    assert "To see." in a["abstract"] and "AIM" in a["abstract"]
    assert one("medline", "<MedlineCitation><PMID>1</PMID></MedlineCitation>") is None


PMC = """<?xml version="1.0"?><!DOCTYPE article PUBLIC "-//NLM//DTD" "x.dtd"><article article-type="research-article" xmlns:xlink="http://x"><front><journal-meta><journal-title-group><journal-title>J K</journal-title></journal-title-group><issn pub-type="epub">1-2</issn></journal-meta>
<article-meta><article-id pub-id-type="pmc">9</article-id><article-id pub-id-type="pmid">8</article-id><title-group><article-title>On <b>mice</b></article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Vosek</surname><given-names>J</given-names></name><email>a@x.example</email></contrib><contrib contrib-type="author"><name><surname>Lone</surname></name></contrib><contrib contrib-type="editor"><name><surname>No</surname><given-names>N</given-names></name></contrib><aff><institution>U</institution><country>C</country></aff></contrib-group>
<pub-date><year>2011</year></pub-date><pub-date><year>2010</year></pub-date><abstract><p>One.</p><p>Two.</p></abstract></article-meta></front><body><supplementary-material><media xlink:href="a.pdf"><label>L</label></media><media xlink:href="b.pdf"/></supplementary-material></body>
<back><ref-list><ref><mixed-citation><name><surname>Qu</surname><given-names>Z</given-names></name>, <source>Nat</source> <year>1999</year><pub-id pub-id-type="pmid">194</pub-id></mixed-citation></ref><ref><citation><fpage>5</fpage></citation></ref></ref-list></back></article>"""


def test_pmc():
    a = one("pmc", PMC)
    assert (a["externalId"], a["pmid"], a["journal"], a["eIssn"], a["year"]) == ("PMC9", "8", "J K", "1-2", "2010")
    assert a["authors"] == "Vosek, J" and a["authorEmails"] == "a@x.example" and a["authorAffiliations"] == "U, C" and a["title"] == "On mice" and a["abstract"] == "One. Two."
    assert ax.pmc_supplements(ax.tree(PMC)) == {"a.pdf": "Supp. File 1 - L", "b.pdf": "Supp. File 2"}
    refs = ax.pmc_references(ax.tree(PMC))
    assert [(r["authors"], r["journal"], r["year"], r["pmid"], r["page"]) for r in refs] == [("Qu, Z", "Nat", "1999", "194", ""), ("", "", "", "", "5")]
    assert one("pmc", "<other/>") == {"articleType": "noContent"}


def test_elsevier():
    xml = """<document xmlns:dc="http://dc"><RDF><Description><dc:title>T</dc:title><doi>10.1/e</doi><publicationName>J</publicationName><coverDisplayDate>March 2005</coverDisplayDate><creator><seq><li>A. Vosek</li></seq></creator></Description></RDF>
    <document-properties><raw-text>plain</raw-text></document-properties><converted-article><head><author-group><author><given-name>Jana</given-name><surname>Vosek</surname></author></author-group><abstract class="graphical"><p>pic</p></abstract><abstract> Abstract  Text here</abstract></head></converted-article></document>"""
    a = one("elsevier", xml)
    assert (a["title"], a["externalId"], a["year"], a["authors"], a["abstract"], a["articleType"]) == ("T", "10.1/e", "2005", "Vosek, Jana", "Text here", "converted-article")
    assert ax.elsevier_text(ax.tree(xml)) == "plain" and one("elsevier", "<document/>") is None
    assert ax.likely_year("Copyright 2003 Somebody") == "2003" and ax.last_number("") == ""


def test_springer():
    xml = """<Publisher><Journal><JournalInfo><JournalTitle>J</JournalTitle><JournalSubjectGroup><JournalSubject>Bio; x</JournalSubject></JournalSubjectGroup></JournalInfo><Volume><VolumeInfo><VolumeIDStart>2</VolumeIDStart></VolumeInfo><Issue><IssueInfo><IssueIDStart>3</IssueIDStart><IssueHistory><CoverDate><Year>1998</Year></CoverDate></IssueHistory></IssueInfo>
    <Article><ArticleInfo><ArticleDOI>10.1/s</ArticleDOI><ArticleTitle>On <Emphasis>mice</Emphasis></ArticleTitle><ArticleFirstPage>11</ArticleFirstPage></ArticleInfo><ArticleHeader><AuthorGroup><Author><AuthorName><GivenName>Jana</GivenName><GivenName>V</GivenName><FamilyName>Vosek</FamilyName></AuthorName><Contact><Email>j@x.example</Email></Contact></Author></AuthorGroup>
    <Abstract><Heading>Abstract</Heading><Para>One.</Para><Heading>Aim</Heading><Para>Two.</Para></Abstract><KeywordGroup><Keyword>mice</Keyword></KeywordGroup></ArticleHeader></Article></Issue></Volume></Journal></Publisher>"""
    a = one("springer", xml)
    assert (a["journal"], a["vol"], a["issue"], a["year"], a["page"], a["title"]) == ("J", "2", "3", "1998", "11", "On mice")
    assert a["authors"] == "Vosek, Jana V" and a["authorEmails"] == "j@x.example" and a["abstract"] == "One.<b>Aim: <b>Two." and a["keywords"] == "Bio, x; mice"
    assert one("springer", "<Publisher/>") is None


def test_tables_of_documents(spark):
    d = spark.createDataFrame([(1, PMC), (2, None), (3, "no xml"), (4, "")], "fileid long, content string")
    got = ax.articles_from_xml(d, "pmc").collect()
    assert [(r["fileid"], r["externalId"]) for r in got] == [(1, "PMC9")]
    assert sorted(r["pmid"] for r in ax.references_from_xml(d).collect()) == ["", "194"]
    assert ax.articles_from_xml(d.limit(0), "medline").count() == 0
